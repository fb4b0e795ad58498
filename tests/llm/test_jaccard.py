from __future__ import annotations

import random
import re

import numpy as np
import pytest

from pressroom.llm import jaccard
from pressroom.llm.components import components


def brute_force(rows):
    """(doc_id, n, component) of each row, by comparing all pairs of rows."""
    sets = []
    for _, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    smallest = {}
    for (doc, _), g, s in zip(rows, group, sets, strict=True):
        if doc is not None and s:
            smallest[g] = min(doc, smallest.get(g, doc))
    return [(doc, len(s), smallest.get(g) if s else doc) for (doc, _), g, s in zip(rows, group, sets, strict=True)]


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(session, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [draw.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(8):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([3, 30, 120]))]
        for _ in range(draw.choice([1, 4, 15])):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2, 4, 7])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            if draw.random() < 0.5:
                copy = copy + common[: draw.randrange(60)]
            rows.append((len(rows), " ".join(copy)))
    df = session.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.jaccard_components(df)) == sorted(brute_force(rows), key=repr)


def test_links_exactly_at_the_threshold(session):
    # 15 of 20 shingles in common: linked; 14 of 20: not
    base = [f"a{i}" for i in range(19)]
    rows = [(5, " ".join(base)), (9, " ".join([*base, "b0", "b1", "b2", "b3", "b4"])), (7, " ".join([*base, "c0", "c1", "c2", "c3", "c4", "c5"]))]
    df = session.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.jaccard_components(df)) == [(5, 15, 5), (7, 21, 7), (9, 20, 5)]


def test_odd_rows(session, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = result(jaccard.jaccard_components(odd))
    assert got == sorted(brute_force(rows), key=repr)
    assert result(jaccard.jaccard_components(nothing)) == []


def test_many_rows_of_one_id_and_without_id(session, monkeypatch):
    draw = random.Random(8)
    rows = []
    for k in range(40):
        base = [f"t{k}w{i}" for i in range(60)]
        for doc in (5, None, 100 + k):
            rows.append((doc, " ".join([*base, *(f"c{draw.random()}" for _ in range(draw.randrange(4)))])))
    rows += rows[:6]
    verify = jaccard._whole_sets
    texts = session.sparkContext.accumulator(0)

    def counted(size):
        inner = verify(size)

        def run(batches):
            def each():
                for batch in batches:
                    texts.add(batch.num_rows)
                    yield batch

            return inner(each())

        return run

    monkeypatch.setattr(jaccard, "_whole_sets", counted)
    got = result(jaccard.jaccard_components(session.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted(brute_force(rows), key=repr)
    assert 0 < texts.value <= len(rows)  # no text is read once for each class of its id


def test_prefix_lengthens_with_cost():
    shingles = np.arange(1, 201, dtype=np.uint64)
    cheap, one = jaccard.prefix(shingles, np.ones(200, np.int64), 75)
    dear, more = jaccard.prefix(shingles, np.full(200, 5000), 75)
    assert len(cheap) - one == len(dear) - more == 200 - 150
    assert more >= one >= 1


def test_components(session):
    edges = [(3, 2), (2, 1), (9, 8), (8, 7), (7, 9), (20, 21), (21, 5), (30, 30)]
    got = {r.node: r.root for r in components(session.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 5, 21: 5, 5: 5}
    chain = [(i, i + 1) for i in range(40)]
    assert {r.root for r in components(session.createDataFrame(chain, "a long, b long")).collect()} == {0}
    assert components(session.createDataFrame([], "a long, b long")).count() == 0
