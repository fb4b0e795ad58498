from datetime import date

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pressroom.config import TrainingParams
from pressroom.operators import evaluation, factors, interactions, residuals
from pressroom.plans import recommend

# two groups of readers, who keep to two articles each; article 21 is read by both groups
TOY = [
    # client, external id, article, seconds, session, published
    (1, "20", 31, 40, 4, 1),
    (1, "21", 32, 35, 4, 2),
    (2, "20", 31, 50, 5, 1),
    (2, "21", 32, 20, 5, 2),
    (3, "21", 32, 10, 5, 2),
    (4, "22", 33, 45, 4, 3),
    (4, "23", 34, 30, 6, 4),
    (5, "21", 32, 5, 6, 2),
    (5, "22", 33, 25, 6, 3),
    (5, "23", 34, 15, 6, 4),
]
DAY = date(2022, 1, 6)


@pytest.fixture(scope="module")
def toy(spark):
    data = [
        (a, e, str(c), date(2022, 1, s), d, date(2022, 1, p)) for c, e, a, d, s, p in TOY
    ]
    schema = "article_id long, external_id string, client_id string, session_date date, duration long, published_at date"
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def prepared(toy):
    return interactions.prepare_interactions(toy)


def test_codes(prepared):
    assert rows(prepared.select("external_id", "item_id").distinct()) == [("20", 0), ("21", 1), ("22", 2), ("23", 3)]
    assert rows(prepared.select("client_id", "user_id").distinct()) == [(str(n), n - 1) for n in range(1, 6)]
    assert rows(prepared.select("session_date", "timestamp").distinct())[0] == (date(2022, 1, 4), 1)


def test_incomplete_rows_go(toy):
    holed = toy.withColumn("published_at", F.when(F.col("client_id") != "2", F.col("published_at")))
    assert interactions.prepare_interactions(holed).count() == 8


def test_one_dimension_row_per_external_id(toy):
    again = toy.filter("external_id = '21'").limit(1).selectExpr(
        "article_id - 5 as article_id", "external_id", "client_id", "session_date", "duration", "published_at"
    )
    later = again.selectExpr(
        "article_id + 90 as article_id", "external_id", "client_id", "session_date", "duration",
        "date_add(published_at, 1) as published_at",
    )
    prepared = interactions.prepare_interactions(toy.unionByName(again))
    assert rows(interactions.item_dimension(prepared, DAY, 1.0), "external_id", "article_id", "decay") == [
        ("20", 31, 0.5**5), ("21", 27, 0.5**4), ("22", 33, 0.5**3), ("23", 34, 0.5**2),
    ]
    prepared = interactions.prepare_interactions(toy.unionByName(later))
    assert interactions.item_dimension(prepared, DAY, 1.0).filter("external_id = '21'").first()["article_id"] == 117


def test_most_read(toy):
    assert rows(interactions.most_read_article(toy)) == [("21", 4)]


@pytest.mark.parametrize("implicit", [True, False])
def test_fit_gives_a_unit_vector_per_item(prepared, implicit):
    params = TrainingParams(rank=4, iterations=5, implicit=implicit)
    watched = prepared.withColumn("duration", F.col("duration") + 1)  # nothing watched is a zero vector
    vectors = factors.item_embeddings(factors.train(watched, params)).collect()
    assert sorted(r["item_id"] for r in vectors) == [0, 1, 2, 3]
    assert all(abs(np.linalg.norm(r["embedding"]) - 1) < 1e-6 for r in vectors)


def test_recs_of_the_toy_set(toy):
    params = TrainingParams(rank=16, iterations=15, half_life=1e9, alpha=10.0)
    recs = recommend.article_recs_from(toy, params, DAY, max_recs=2)
    found = rows(recs.filter("source_entity_id = '20'").orderBy(F.desc("score")), "recommended_article_id")
    # all readers of article 31 read 32 too
    assert (32,) in found and len(found) == 2
    assert recs.count() == 8
    assert recs.filter("recommended_article_id = cast(source_entity_id as long) + 11").count() == 0


def test_split_is_stable_and_complete(toy):
    train, test = evaluation.split_interactions(toy)
    assert train.count() + test.count() == 10
    assert rows(train) == rows(evaluation.split_interactions(toy.repartition(3))[0])


def tied_rank(scores, mine):
    better = sum(s > mine for s in scores)
    equal = sum(s == mine for s in scores)
    return better + (equal + 1) / 2


def test_ranks_equal_brute_force(spark):
    draw = np.random.default_rng(7)
    # reader 0 has most of the scores
    data = [(0 if n % 4 else n % 12, n, float(draw.integers(0, 20))) for n in range(800)]
    scores = spark.createDataFrame(data, "user_id long, item_id long, score double")
    held = scores.filter("item_id % 5 = 0").select("user_id", "item_id")
    found = {(r["user_id"], r["item_id"]): r["rank"] for r in evaluation.ranks(scores, held).collect()}
    want = {
        (u, i): tied_rank([t for v, _, t in data if v == u], s) for u, i, s in data if i % 5 == 0
    }
    assert found == want
    per_user = {}
    for (u, _), rank in want.items():
        per_user.setdefault(u, []).append(1 / rank)
    expected = np.mean([np.mean(x) for x in per_user.values()])
    assert evaluation.mrr(evaluation.ranks(scores, held)).first()["mrr"] == pytest.approx(expected)


@pytest.mark.parametrize("block_rows", [5, 2048])
def test_factor_ranks_equal_brute_force(spark, block_rows):
    draw = np.random.default_rng(8)
    users, items = draw.normal(size=(6, 3)), draw.normal(size=(23, 3))
    schema = "id int, features array<float>"
    user_factors = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(users)], schema)
    item_factors = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(items)], schema)
    pairs = [(u, i) for u in range(6) for i in range(23) if (u + i) % 4 == 0] + [(99, 1), (1, 99)]
    held = spark.createDataFrame(pairs, "user_id int, item_id int")
    found = evaluation.factor_ranks(user_factors, item_factors, held, block_rows)
    scores = np.round(users.astype(np.float32).astype(float) @ items.astype(np.float32).astype(float).T, 6)
    want = [(u, i, tied_rank(scores[u], scores[u, i]), False) for u, i in pairs if u < 9 and i < 90]
    # a reader without factors sees all 23 items tied, an item without factors comes last
    want += [(99, 1, 12.0, True), (1, 99, 24.0, True)]
    assert rows(found, "user_id", "item_id", "rank", "cold") == sorted(want, key=repr)


def test_unscored_pairs_keep_a_rank(spark):
    scores = spark.createDataFrame([(1, 1, 3.0), (1, 2, 2.0), (2, 3, 1.0)], "user_id int, item_id int, score double")
    held = spark.createDataFrame([(1, 2), (1, 9), (7, 1)], "user_id int, item_id int")
    assert rows(evaluation.ranks(scores, held), "user_id", "item_id", "rank") == [(1, 2, 2.0), (1, 9, 3.0), (7, 1, 2.0)]


def test_grid(prepared):
    assert factors.grid({"rank": (2, 7, 2), "iterations": (1, 3, 1)}) == [
        {"rank": r, "iterations": n} for r in (2, 4, 6) for n in (1, 2)
    ]
    for wrong in ({}, {"nonsense": (1, 2, 1)}, {"rank": (5, 5, 1)}, {"rank": (1, 2)}):
        with pytest.raises(ValueError):
            factors.grid(wrong)
    params = TrainingParams(rank=2, iterations=1, tune=True, tune_ranges={"rank": (2, 5, 2)})
    results, best = factors.grid_search(prepared, params)
    assert results.count() == 2 and best.rank in (2, 4)
    top = results.orderBy(F.desc_nulls_last("mrr"), "combination").first()
    assert top["params"]["rank"] == best.rank


def residual_by_hand(user, items, ratings, params):
    rank = len(next(iter(items.values())))
    left, right = np.zeros((rank, rank)), np.zeros(rank)
    for i, r in ratings:
        weight = params.alpha * r if params.implicit else 1.0
        left += weight * np.outer(items[i], items[i])
        right += (1 + weight if params.implicit else r) * items[i]
    if params.implicit:
        left += sum(np.outer(v, v) for v in items.values())
    left += params.regularisation * len(ratings) * np.eye(rank)
    return np.linalg.norm(left @ user - right) / np.linalg.norm(right)


@pytest.mark.parametrize("implicit", [True, False])
def test_residuals_equal_brute_force_and_tell_a_wrong_fit(prepared, implicit):
    params = TrainingParams(rank=3, iterations=2, implicit=implicit, alpha=3.0)
    watched = prepared.withColumn("duration", F.col("duration") + 5)
    model, ratings = factors.fit(watched, params), factors.rating_table(watched, implicit)
    vectors = [{r["id"]: np.array(r["features"], float) for r in f.collect()} for f in (model.userFactors, model.itemFactors)]
    mine = {}
    for r in ratings.collect():
        mine.setdefault(r["user_id"], []).append((r["item_id"], r["rating"]))
    for given, solved in ((params, True), (params.with_values(regularisation=0.3), False), (params.with_values(alpha=1.0), not implicit)):
        found = {r["user_id"]: (r["n_ratings"], r["residual"]) for r in residuals.reader_residuals(model.userFactors, model.itemFactors, ratings, given).collect()}
        assert found.keys() == vectors[0].keys()
        for u, (n, residual) in found.items():
            assert n == len(mine[u]) and residual == pytest.approx(residual_by_hand(vectors[0][u], vectors[1], mine[u], given), abs=1e-6)
        assert (max(r for _, r in found.values()) < 1e-4) == solved


def test_gramian_of_nothing(spark):
    assert residuals.gramian(spark.createDataFrame([], "features array<float>")).shape == (0, 0)


def test_another_model_in_the_grid(prepared):
    tried = []

    def fitter(train, params):
        tried.append(params.rank)
        return factors.fit(train, params.with_values(iterations=1))

    results, best = factors.grid_search(prepared, TrainingParams(rank=2, tune_ranges={"rank": (2, 4, 1)}), fitter)
    assert tried == [2, 3] and results.count() == 2 and best.rank in tried
