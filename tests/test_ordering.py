import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pressroom.operators import ordering


def test_positions_over_many_ranges(spark):
    values = [f"{n:05d}" for n in range(2000)]
    random.Random(1).shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    found = ordering.numbered(frame, [F.col("v").desc()], "p", parts=7)
    assert rows(found, "p", "v") == sorted(((p, f"{1999 - p:05d}") for p in range(2000)), key=repr)


def test_dense_codes_skip_nulls_and_repeats(spark):
    frame = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("B",)], "v string")
    assert rows(ordering.dense_codes(frame, "v", "code")) == [("B", 0), ("a", 1), ("b", 2)]
    assert rows(ordering.with_dense_code(frame, "v", "code"), "v", "code").count(("b", 2)) == 2


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_totals_of_a_group_cut_by_ranges(spark, parts):
    draw = random.Random(2)
    # one group has nine tenths of the rows
    data = [("hot" if n % 10 else f"g{n % 30}", n, draw.randint(1, 5)) for n in range(1500)]
    frame = spark.createDataFrame(data, "g string, n int, w int")
    found = ordering.total_before(frame, ["g"], [F.col("n").desc()], F.col("w"), "before", parts)
    expected, running = [], {}
    for g, n, w in sorted(data, key=lambda r: -r[1]):
        expected.append((g, n, w, running.get(g, 0)))
        running[g] = running.get(g, 0) + w
    assert rows(found, "g", "n", "w", "before") == sorted(expected, key=repr)


def test_empty_input(spark):
    frame = spark.createDataFrame([], "g string, n int")
    assert ordering.numbered(frame, [F.col("n")], "p").count() == 0
    assert ordering.total_before(frame, ["g"], [F.col("n")], F.lit(1), "b").count() == 0
