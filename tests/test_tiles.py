import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from test_similarity import brute, items

from pressroom.operators import evaluation, similarity, tiles


def handed_over(monkeypatch, module, run):
    """For each call of ``tile_apply`` while ``run`` is at work: the rows of its left side, and the copies of rows of its right side."""
    seen, original = [], module.tile_apply

    def counting(wanted, left, right, work, schema):
        seen.append((left.count(), right.join(wanted.distinct(), "_rb").count()))
        return original(wanted, left, right, work, schema)

    with monkeypatch.context() as patched:
        patched.setattr(module, "tile_apply", counting)
        run()
    return seen


def test_sources_are_handed_over_once_however_small_the_blocks(spark, monkeypatch):
    """Directions without any order: every block matters to every source."""
    data = items(spark, np.random.default_rng(12).normal(size=(300, 8)), [1.0] * 300)
    first, rest = handed_over(monkeypatch, similarity, lambda: similarity.nearest(data, 5, 4, cells=2).collect())
    assert first[0] == rest[0] == 300 and first[1] <= 300 + 2 * 4 and rest[1] <= tiles.sweeps(300) * 300


def test_users_are_handed_over_once_however_small_the_blocks(spark, monkeypatch):
    draw = np.random.default_rng(13)
    frames = [spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(draw.normal(size=(size, 6)))], "id int, features array<float>") for size in (20, 200)]
    held = spark.createDataFrame([(u, i) for u in range(20) for i in range(u, 200, 9)], "user_id int, item_id int")
    ((users, copies),) = handed_over(monkeypatch, evaluation, lambda: evaluation.factor_ranks(*frames, held, 4, cells=2).collect())
    assert users == 20 and copies <= tiles.sweeps(20) * 200


def test_groups_stay_as_many_until_one_would_be_too_large():
    assert [tiles.sweeps(n) for n in (0, 1, 256, 257, 100_000, 1_000_000)] == [1, 1, 1, 2, 36, 36]
    assert tiles.sweeps(10_000_000) == -(-10_000_000 // tiles.MOST_SWEPT)


def test_thresholds_are_those_of_rounding():
    draw = np.random.default_rng(14)
    scores = np.concatenate([draw.integers(-9, 9, 60) / 2e6, draw.normal(size=40) * 3e-6])
    above, from_ = evaluation.thresholds(scores)
    rounded, scaled = np.round(scores, 6), scores * 1e6
    assert ((scaled[:, None] > above) == (rounded[:, None] > rounded)).all()
    assert ((scaled[:, None] > from_) == (rounded[:, None] >= rounded)).all()


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_counting_equals_brute_force_and_leaves_blocks_out(spread):
    draw = np.random.default_rng(15)
    middles = draw.normal(size=(40, 5))
    vectors = np.repeat(middles, 25, axis=0) + spread * draw.normal(size=(1000, 5))
    vectors[::50] = vectors[0]  # ties, also within a user's own
    users, n = draw.normal(size=(9, 5)), np.array([1, 2, 30, 1, 3, 12, 11, 40, 1])
    first = np.concatenate([[0], np.cumsum(n)])
    held = np.concatenate([draw.choice(1000, k, replace=False) for k in n])
    row = np.repeat(np.arange(9), n)
    scores = users @ vectors.T
    counting = evaluation.Counting(users, first, held, scores[row, held])
    for at in range(0, 1000, 300):  # pieces that cut blocks
        some = slice(at, at + 300)
        counting.meet(np.arange(1000)[some] // 25, np.arange(1000)[some], vectors[some])
    rounded = np.round(scores, 6)
    mine = rounded[row, held][:, None]
    better, equal = counting.counts()
    assert (better == (rounded[row] > mine).sum(axis=1)).all() and (equal == (rounded[row] == mine).sum(axis=1)).all()
    one = evaluation.Counting(users[:1], first[:2], held[:1], scores[0, held[:1]])
    one.meet(np.arange(1000) // 25, np.arange(1000), vectors)
    assert (one.counts()[0] == better[0]) and (spread == 1.0 or one.multiplied < 0.8 * 1000)


def test_best_equals_brute_force_and_leaves_blocks_out():
    draw = np.random.default_rng(16)
    vectors = np.repeat(draw.normal(size=(20, 8)), 30, axis=0) + 0.02 * draw.normal(size=(600, 8))
    vectors[5], decay, ids = 0, np.repeat(draw.choice([1.0, 0.5], 20), 30), np.arange(600)
    best = similarity.Best(ids, vectors, 4)
    for at in range(0, 600, 60):
        some = slice(at, at + 60)
        best.meet(ids[some] // 30, ids[some], vectors[some], decay[some])
        best.settle()
    found = best.result().to_pandas()
    want = pd.DataFrame(brute(vectors, decay, 4), columns=["item_id", "neighbour_id", "score", "position"])
    assert (found["item_id"].to_numpy() == want["item_id"]).all() and (found["neighbour_id"].to_numpy() == want["neighbour_id"]).all()
    assert np.allclose(found["score"], want["score"], atol=2e-9)
    again = similarity.Best(ids, vectors, 4, found.groupby("item_id")["score"].min().to_numpy(), np.full(600, -1))
    again.meet(ids // 30, ids, vectors, decay)
    assert again.multiplied < 0.9 * 600 * 600 and again.result().to_pandas().equals(found)


def test_blocks_are_packed_and_every_row_arrives(spark):
    """A row is dear on its way to Python, so a block is one row there, and a group not many."""
    right = spark.range(1000).selectExpr("cast(id % 3 as int) as _rb", "id as right")
    packed = tiles._packed(right, "_rb", "block")
    assert sorted(len(r["block"]) for r in packed.collect()) == [333, 333, 334]
    left = spark.range(500).selectExpr("cast(id % 2 as int) as _lb", "id as left")
    assert tiles._packed(left, "_lb", "rows", tiles.LEFT_PACKS).count() <= 2 * tiles.LEFT_PACKS
    wanted = spark.createDataFrame([(0, 0), (0, 2), (1, 1)], "_lb int, _rb int")

    def work(rows, pieces):
        found = list(pieces)
        total = sum(sum(p.column("right").to_pylist()) for p in found)
        blocks = sorted({x for p in found for x in p.column("_rb").to_pylist()})
        yield pa.RecordBatch.from_arrays([pa.array([len(rows)]), pa.array([total]), pa.array([str(blocks)])], ["n", "total", "blocks"])

    found = sorted(tuple(r) for r in tiles.tile_apply(wanted, left, right, work, "n long, total long, blocks string").collect())
    own = [sum(range(k, 1000, 3)) for k in range(3)]
    assert found == sorted([(250, own[0] + own[2], "[0, 2]"), (250, own[1], "[1]")])


def counted(users, first, held, held_scores, ids, vectors, block, piece):
    counting = evaluation.Counting(users, first, held, held_scores)
    for at in range(0, len(ids), piece):
        some = slice(at, at + piece)
        counting.meet(block[some], ids[some], vectors[some])
    return counting, *counting.counts()


def test_scores_that_round_alike_are_counted_without_products():
    """Weak factors: every score rounds to nothing, and all items are tied."""
    draw = np.random.default_rng(18)
    users, vectors, ids = 1e-4 * draw.normal(size=(40, 4)), 1e-4 * draw.normal(size=(3000, 4)), np.arange(3000)
    first, held = np.arange(41), draw.choice(3000, 40)
    counting, better, equal = counted(users, first, held, (users * vectors[held]).sum(axis=1), ids, vectors, ids // 1000, 2048)
    assert counting.multiplied == 0 and not better.any() and (equal == 3000).all()


@pytest.mark.parametrize("n_held", [2, 20])
@pytest.mark.parametrize("scale", [2e-3, 1e-2])
def test_counting_equals_brute_force_where_much_is_settled(scale, n_held):
    """Blocks of more items than a part, more queries than a tile, many ties after rounding."""
    draw = np.random.default_rng(19)
    users, vectors, ids = scale * draw.normal(size=(700, 3)), scale * draw.normal(size=(2500, 3)), np.arange(2500)
    vectors = vectors[np.argsort(vectors[:, 0])]
    first = np.arange(701) * n_held
    held = np.concatenate([draw.choice(2500, n_held, replace=False) for _ in users])
    row, scores = np.repeat(np.arange(700), n_held), np.array([[sum(x * y for x, y in zip(u, v, strict=True)) for v in vectors] for u in users[:50]])
    some = row < 50
    _, better, equal = counted(users, first, held, (users[row] * vectors[held]).sum(axis=1), ids, vectors, ids // 1250, 2048)
    rounded = np.rint(scores * 1e6)
    mine = rounded[row[some], held[some]][:, None]
    assert (better[some] == (rounded[row[some]] > mine).sum(axis=1)).all() and (equal[some] == (rounded[row[some]] == mine).sum(axis=1)).all()


def test_halves_are_rounded_to_the_even_neighbour():
    """Scores in 128ths are halves of the last digit."""
    draw = np.random.default_rng(20)
    users, vectors, ids = draw.integers(-2, 3, (60, 2)) / 8.0, draw.integers(-3, 4, (500, 2)) / 16.0, np.arange(500)
    first, held = np.arange(61) * 3, np.concatenate([draw.choice(500, 3, replace=False) for _ in users])
    row, rounded = np.repeat(np.arange(60), 3), np.rint(users @ (vectors * 1e6).T)
    _, better, equal = counted(users, first, held, (users[row] * vectors[held]).sum(axis=1), ids, vectors, ids // 100, 300)
    mine = rounded[row, held][:, None]
    assert (better == (rounded[row] > mine).sum(axis=1)).all() and (equal == (rounded[row] == mine).sum(axis=1)).all()


def test_all_rows_of_an_item_tie_with_it():
    """An item may have other factors in a block that is settled as a whole."""
    users, vectors = np.array([[1.0, 0.0]]), np.repeat([[0.5, 0.1], [0.9, 0.2], [0.1, 0.3]], 4, axis=0)
    ids = np.array([1, 2, 3, 4, 1, 5, 6, 7, 1, 8, 9, 10])
    _, better, equal = counted(users, np.array([0, 1]), np.array([1]), np.array([0.5]), ids, vectors, np.arange(12) // 4, 12)
    assert (better, equal) == (3, 6)


def test_parts_of_an_open_block_are_settled():
    draw = np.random.default_rng(21)
    users, vectors, ids = draw.normal(size=(30, 2)), draw.uniform(size=(2000, 2)), np.arange(2000)
    first, held = np.arange(31), draw.choice(2000, 30)
    scores = users @ vectors.T
    counting, better, equal = counted(users, first, held, scores[np.arange(30), held], ids, vectors, np.zeros(2000, int), 2048)
    rounded = np.round(scores, 6)
    mine = rounded[np.arange(30), held][:, None]
    assert (better == (rounded > mine).sum(axis=1)).all() and (equal == (rounded == mine).sum(axis=1)).all()
    assert counting.multiplied < 0.8 * 30 * 2000
