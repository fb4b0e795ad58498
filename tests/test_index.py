import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_similarity import check, items

from pressroom.functions.vectors import norm
from pressroom.operators import evaluation, index, similarity


def clustered(n, size, seed=1):
    """``n`` groups of ``size`` vectors around directions far from each other."""
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(n, 12))
    return np.repeat(middles, size, axis=0) + 0.02 * draw.normal(size=(n * size, 12))


def tiles_of(monkeypatch, module, run, rows=False):
    """Pairs of blocks that are multiplied while ``run`` is at work, or rows that are copied for it."""
    seen, original = [], module.tile_apply

    def counting(left, right, work, schema, left_blocks):
        pairs = left.select("_lb", "_rb")
        seen.append(pairs.count() if rows else pairs.distinct().count())
        return original(left, right, work, schema, left_blocks)

    with monkeypatch.context() as patched:
        patched.setattr(module, "tile_apply", counting)
        run()
    return seen


@pytest.mark.parametrize("cells", [1, 3, 20])
def test_neighbours_with_equal_decays_equal_brute_force(spark, cells):
    vectors = np.vstack([clustered(5, 20), np.zeros((3, 12)), np.random.default_rng(2).normal(size=(20, 12))])
    data = items(spark, vectors, [1.0] * len(vectors))
    found = {(r["item_id"], r["position"]): r["neighbour_id"] for r in similarity.nearest(data, 4, 8, cells).collect()}
    whole = {(r["item_id"], r["position"]): r["neighbour_id"] for r in similarity.nearest(data, 4, 4096).collect()}
    assert found == whole
    if cells == 3:
        check(spark, vectors, [1.0] * len(vectors), 4, 4096)


def test_tiles_grow_with_the_rows_and_not_with_their_square(spark, monkeypatch):
    counts = {}
    for n in (6, 24):
        data = items(spark, clustered(n, 20), [1.0] * (20 * n))
        first, rest = tiles_of(monkeypatch, similarity, lambda: similarity.nearest(data, 5, 20, cells=4 * n).collect())  # noqa: B023
        blocks = index.block_index(data, "item_id", "embedding", "decay", 20 * n, 20, 4 * n, unit=True).n_blocks
        counts[n] = (first + rest, blocks)
    # four times the rows: sixteen times the pairs of blocks, about four times the tiles
    assert counts[24][0] < 6 * counts[6][0]
    assert counts[24][0] < counts[24][1] ** 2 / 4


@pytest.mark.parametrize("unit", [True, False])
def test_bounds_hold(spark, unit):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(90, 5)) * draw.uniform(0, 9, (90, 1))
    data = items(spark, vectors, draw.uniform(size=90))
    found = index.block_index(data, "item_id", "embedding", "decay", 90, 10, 4, unit=unit)
    rows, summary = found.rows.toPandas(), found.summary.toPandas().sort_values("_block")
    assert len(rows) == 90 and summary["n_rows"].sum() == 90 and summary["n_rows"].max() <= 10
    assert list(summary["_block"]) == list(range(found.n_blocks))
    queries = draw.normal(size=(30, 5))
    low, high = index.dot_bounds(queries, summary)
    for n, block in enumerate(summary["_block"]):
        mine = rows[rows["_block"] == block]
        products = queries @ index.matrix(mine["embedding"], unit).T
        assert (products >= low[:, [n]] - 1e-9).all() and (products <= high[:, [n]] + 1e-9).all()
        assert summary["top"].iloc[n] == mine["decay"].max()


@pytest.mark.parametrize("cells", [1, 6])
def test_ranks_leave_blocks_out(spark, monkeypatch, cells):
    draw = np.random.default_rng(11)
    users, vectors = np.abs(draw.normal(size=(12, 4))), draw.normal(size=(300, 4)) * 0.94 ** np.arange(300)[:, None]
    vectors[::7] = vectors[0]  # ties
    schema = "id int, features array<float>"
    frames = [spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(m)], schema) for m in (users, vectors)]
    pairs = [(u, i) for u in range(12) for i in range(u % 5, 300, 25)]
    held = spark.createDataFrame(pairs, "user_id int, item_id int")
    found = {}
    (copies,) = tiles_of(
        monkeypatch, evaluation, lambda: found.update({(r[0], r[1]): r[2] for r in evaluation.factor_ranks(*frames, held, 10, cells).collect()}), rows=True
    )
    scores = np.round(users.astype(np.float32).astype(float) @ vectors.astype(np.float32).astype(float).T, 6)
    for u, i in pairs:
        better, equal = (scores[u] > scores[u, i]).sum(), (scores[u] == scores[u, i]).sum()
        assert found[u, i] == better + (equal + 1) / 2
    lengths = frames[1].withColumn("length", norm(F.col("features")))
    n_blocks = index.block_index(lengths, "id", "features", "length", 300, 10, cells).n_blocks
    assert n_blocks >= 30 and copies < len(pairs) * n_blocks * 0.6


def test_open_blocks_settle_what_the_bounds_tell():
    held = pd.DataFrame({"user_id": [1], "item_id": [2], "user_factors": [[1.0, 0.0]], "score": [2.0], "_lb": [0]})
    blocks = [([5.0, 0.0], 1.0, 6.0, 10), ([0.0, 0.0], 1.0, 1.0, 20), ([2.0, 0.0], 0.5, 2.5, 30)]
    summary = pd.DataFrame(
        [(n, c, r, longest, 0.0, rows) for n, (c, r, longest, rows) in enumerate(blocks)], columns=["_block", "centre", "radius", "longest", "top", "n_rows"]
    )
    found = evaluation.open_blocks(held, summary)
    assert list(found["_rb"].dropna()) == [2] and list(found["better"].dropna()) == [10]


def test_every_cell_is_cut_for_itself(spark):
    data = items(spark, clustered(3, 25), range(75))
    found = index.block_index(data, "item_id", "embedding", "decay", 75, 10, 3, unit=True).rows
    by_block = found.groupBy("_block").agg(F.count_distinct("_home").alias("homes"), F.count(F.lit(1)).alias("n"))
    assert by_block.filter("homes > 1 OR n > 10").count() == 0
