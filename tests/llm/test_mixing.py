from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from pressroom.llm import mixing


def number(*parts):
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16)


def poisson(mean, u):
    k, p = 0, math.exp(-mean)
    total = p
    while total <= u and k < 119:
        k += 1
        p *= mean / k
        total += p
    return k if total > u else k + 1


def copies(rate, key, seed):
    parts = max(1, math.ceil(rate / mixing.MOST_MEAN))
    return sum(poisson(rate / parts, number(str(seed), key, str(i)) / 2**52) for i in range(1, parts + 1))


@pytest.fixture()
def docs(session):
    # one source holds most of the rows, one is tiny and asked for often
    rows = [(i, "x" * (1 + i % 50), "big" if i % 10 else ("tiny" if i % 200 == 0 else "small"), i) for i in range(4000)]
    return session.createDataFrame(rows, "doc_id long, text string, source string, extra int")


def test_mix_equals_brute_force(docs):
    got = {}
    for r in mixing.mix(docs).collect():
        assert r.place == number("17|place", str(r.doc_id), str(r.copy)) and r.extra == r.doc_id
        got.setdefault(r.doc_id, []).append(r.copy)
    rows = docs.collect()
    size = {}
    for r in rows:
        size[r.source] = size.get(r.source, 0) + len(r.text)
    total, weight = sum(size.values()), sum(math.sqrt(v) for v in size.values())
    for r in rows:
        rate = math.sqrt(size[r.source]) * total / (weight * size[r.source])
        assert sorted(got.get(r.doc_id, [])) == list(range(1, copies(rate, str(r.doc_id), 17) + 1))


def test_targets_are_met(session, docs):
    targets = session.createDataFrame([("big", 1.0), ("small", 2.0), ("tiny", 1.0), ("absent", 5.0)], "source string, weight double")
    mixed = mixing.mix(docs, targets)
    sizes = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    total = docs.agg(F.sum(F.length("text"))).first()[0]
    for source, share in (("big", 0.25), ("small", 0.5), ("tiny", 0.25)):
        assert sizes[source] == pytest.approx(share * total, rel=0.15)
    only = mixing.mix(docs, targets.filter("source = 'small'"))
    assert {r.source for r in only.select("source").distinct().collect()} == {"small"}


def test_poisson_of_large_means(session):
    rows = session.range(3000).select(mixing.copies(F.lit(100.0), F.col("id").cast("string"), 1).alias("k"))
    mean, spread = rows.agg(F.avg("k"), F.variance("k")).first()
    assert mean == pytest.approx(100, abs=1) and spread == pytest.approx(100, rel=0.12)


def test_repeatable_and_shuffled(docs):
    one, two = mixing.mix(docs).drop("text"), mixing.mix(docs.repartition(7)).drop("text")
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_odd_rows(session, odd, nothing):
    assert mixing.mix(nothing).count() == 0
    mixed = mixing.mix(odd.withColumn("copy", F.lit(5)).withColumn("rate", F.lit("mine")))
    assert set(mixed.columns) == {*odd.columns, "rate", "copy", "place"} and mixed.filter("rate <> 'mine'").count() == 0
    empty = session.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0
