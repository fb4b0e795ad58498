import numpy as np
import pytest
from conftest import rows

from pressroom.operators import similarity, tiles


def items(spark, vectors, decays):
    data = [(n, [float(x) for x in v], float(d)) for n, (v, d) in enumerate(zip(vectors, decays))]
    return spark.createDataFrame(data, "item_id long, embedding array<double>, decay double")


def brute(vectors, decays, k):
    vectors, decays = np.array(vectors, float), np.array(decays, float)
    length = np.linalg.norm(vectors, axis=1)
    found = []
    for i in range(len(vectors)):
        scored = []
        for j in range(len(vectors)):
            if i != j:
                both = length[i] * length[j]
                similarity_ij = (1 + vectors[i] @ vectors[j] / both) / 2 if both else 0.0
                scored.append((-round(similarity_ij * decays[j], 9), j))
        found += [(i, j, -s, p) for p, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return found


def check(spark, vectors, decays, k, block_rows):
    got = similarity.nearest(items(spark, vectors, decays), k, block_rows)
    got = {(r["item_id"], r["position"]): (r["neighbour_id"], r["score"]) for r in got.collect()}
    want = {(i, p): (j, s) for i, j, s, p in brute(vectors, decays, k)}
    assert got.keys() == want.keys()
    for key, (neighbour, score) in want.items():
        assert got[key][0] == neighbour and got[key][1] == pytest.approx(score, abs=2e-9)


@pytest.mark.parametrize("block_rows", [7, 50, 2048])
@pytest.mark.parametrize("half_life", [5.0, 1e9])
def test_equals_brute_force(spark, block_rows, half_life):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(120, 6))
    decays = 0.5 ** (draw.integers(-3, 90, 120) / half_life)
    check(spark, vectors, decays, 5, block_rows)


def test_zero_vectors_copies_and_future_dates(spark):
    draw = np.random.default_rng(4)
    vectors = draw.integers(-1, 2, size=(60, 3))  # many equal and zero vectors
    decays = draw.choice([2.0, 1.0, 0.5, 0.0], 60)
    check(spark, vectors, decays, 4, 8)


@pytest.mark.parametrize("n", [1, 2, 4])
def test_fewer_items_than_wanted(spark, n):
    draw = np.random.default_rng(5)
    check(spark, draw.normal(size=(n, 3)), [1.0] * n, 10, 3)


def test_old_blocks_are_left_out(spark):
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(100, 4))
    decays = 0.5 ** np.arange(100)
    seen = []
    original = similarity.tile_apply

    def counting(left, right, work, schema, left_blocks):
        seen.append(left.select("_lb", "_rb").distinct().count())
        return original(left, right, work, schema, left_blocks)

    similarity.tile_apply = counting
    try:
        check(spark, vectors, decays, 3, 10)
    finally:
        similarity.tile_apply = original
    # the first round is 10 tiles, and nine tenths of the remaining 90 are never formed
    assert seen[0] == 10 and seen[1] < 20


def test_a_wanted_block_is_handed_out_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(tiles, "COPIES_PER_TASK", 2)
    draw = np.random.default_rng(9)
    check(spark, draw.normal(size=(90, 3)), draw.random(90), 3, 6)


def test_recs_are_keyed_by_article(spark):
    dimension = spark.createDataFrame(
        [(0, "x0", 10), (1, "x1", 11)], "item_id int, external_id string, article_id long"
    )
    neighbours = spark.createDataFrame([(0, 1, 0.25, 1)], "item_id long, neighbour_id long, score double, position int")
    (row,) = rows(similarity.article_recs(neighbours, dimension))
    assert row[:2] == ("x0", 11) and float(row[2]) == 0.25
