import pytest
from conftest import rows

from pressroom.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    # key 0 holds most rows, some keys are null, some match nothing
    big = spark.sql(
        "select id as n, case when id % 7 = 0 then null when id % 3 <> 0 then 0 else id % 40 end as k, "
        "cast(id % 2 as string) as s from range(3000)"
    )
    lookup = spark.sql("select id as k, cast(j as string) as s, id * 10 + j as v from range(0, 30) lateral view explode(array(0, 1)) as j")
    return big, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("keys", [["k"], ["k", "s"]])
def test_salting_changes_no_result(sides, how, keys):
    big, lookup = sides
    lookup = lookup.select("k", "v") if keys == ["k"] else lookup
    plain = big.join(lookup, keys, how)
    salted = skew.salted_join(big, lookup, keys, how, rows_per_task=40)
    assert rows(salted, *sorted(plain.columns)) == rows(plain, *sorted(plain.columns))


def test_hot_key_is_spread(sides, spark):
    big, lookup = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(big.filter("k = 0"), lookup.select("k", "v").filter("v = 0"), ["k"], rows_per_task=100)
        sizes = [n for n in joined.rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < sum(sizes)


def test_size_decides_on_salting(sides, spark):
    big, lookup = sides
    assert skew.broadcast_limit(big) == 10 * 1024 * 1024
    small = skew.lookup_join(big, lookup.select("k", "v"), ["k"])
    assert "_salt" not in small._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        large = skew.lookup_join(big, lookup.select("k", "v"), ["k"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "_salt" in large._jdf.queryExecution().analyzed().toString()
    with pytest.raises(ValueError):
        skew.lookup_join(big, lookup, ["k"], "full")


def test_every_hot_key_is_spread(spark):
    big = spark.sql("select id % 1000 as k, 'same' as s from range(50000)")
    lookup = spark.sql("select id as k, id * 2 as v from range(1000)")
    joined = skew.salted_join(big, lookup, ["k"], rows_per_task=10)
    assert joined.count() == 50000 and joined.filter("v <> k * 2").count() == 0
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_salts" in plan
    spread = skew.key_counts(big, ["k"]).filter("_rows > 10")
    assert spread.count() == 1000
