"""Interactions, similarity, factor models, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as i
from checks.registry import query
from pressroom.config import TrainingParams
from pressroom.functions import clock, vectors
from pressroom.operators import evaluation, factors, interactions, residuals, similarity
from pressroom.plans import recommend
from pressroom.session import settle

DAYS, MAX_AGE = 365, 2
PARAMS = TrainingParams(half_life=120.0, rank=8, iterations=2)

_WINDOW = "(SELECT * FROM order_dwell WHERE session_date >= DATE '2001-11-04' - 364)"
_TRAINING = f"""
    SELECT d.article_id, d.external_id, d.client_id, d.session_date, d.duration, a.published_at
    FROM {_WINDOW} d
    JOIN (SELECT article_id, count(*) AS n FROM {_WINDOW} GROUP BY article_id) x ON x.article_id = d.article_id
    JOIN (SELECT client_id, count(*) AS n, sum(duration) AS s FROM {_WINDOW} GROUP BY client_id) u
      ON u.client_id = d.client_id
    JOIN order_articles a ON a.id = d.article_id
    WHERE x.n > 5 AND u.n > 2 AND d.duration BETWEEN 30 AND 600 AND u.s > 60
          AND a.published_at > DATE '2001-11-04' - 730
"""
_PREPARED = f"""
    SELECT article_id, external_id, client_id, session_date, duration, published_at,
           dense_rank() OVER (ORDER BY external_id) - 1 AS item_id, dense_rank() OVER (ORDER BY client_id) - 1 AS user_id,
           dense_rank() OVER (ORDER BY session_date) AS "timestamp"
    FROM ({_TRAINING})
"""


def _training(spark, sf):
    dwell = i.stored_order_dwell(spark, sf)
    return interactions.training_interactions(dwell, i.order_articles(dwell), i.ORDER_DAY, MAX_AGE, DAYS)


def _prepared(spark, sf):
    return interactions.prepare_interactions(settle(_training(spark, sf)))


@query(
    "SELECT article_id, count(*) AS rows_per_article FROM order_dwell GROUP BY article_id", "order_dwell"
)
def article_activity(spark, sf):
    return interactions.article_activity(i.order_dwell(spark, sf))


@query(
    "SELECT client_id, count(*) AS rows_per_user, CAST(sum(duration) AS BIGINT) AS seconds_per_user "
    "FROM order_dwell GROUP BY client_id",
    "order_dwell",
)
def user_activity(spark, sf):
    return interactions.user_activity(i.order_dwell(spark, sf))


@query(
    f"""
    SELECT article_id, external_id, client_id, CAST(session_date AS VARCHAR) AS session_date, duration,
           CAST(published_at AS VARCHAR) AS published_at FROM ({_TRAINING})
    """,
    "order_dwell order_articles",
)
def training_interactions(spark, sf):
    return _training(spark, sf)


@query(
    """SELECT client_id, article_id, CAST(session_date AS VARCHAR) AS session_date, duration, external_id, site,
              CAST(published_at AS VARCHAR) AS published_at
       FROM event_dwell WHERE published_at IS NOT NULL""",
    "event_dwell",
)
def drop_incomplete(spark, sf):
    """Every 17th article has no publish date; its rows go."""
    return i.event_dwell(spark, sf).na.drop("any")


@query(
    "SELECT external_id, dense_rank() OVER (ORDER BY external_id) - 1 AS item_id "
    "FROM (SELECT DISTINCT external_id FROM order_dwell)",
    "order_dwell",
)
def item_codes(spark, sf):
    return interactions.dense_codes(i.order_dwell(spark, sf), "external_id", "item_id")


@query(
    "SELECT client_id, dense_rank() OVER (ORDER BY client_id) - 1 AS user_id "
    "FROM (SELECT DISTINCT client_id FROM order_dwell)",
    "order_dwell",
)
def user_codes(spark, sf):
    return interactions.dense_codes(i.order_dwell(spark, sf), "client_id", "user_id")


@query(
    """SELECT CAST(session_date AS VARCHAR) AS session_date, dense_rank() OVER (ORDER BY session_date) AS "timestamp"
       FROM (SELECT DISTINCT session_date FROM order_dwell)""",
    "order_dwell",
)
def date_codes(spark, sf):
    codes = interactions.dense_codes(i.order_dwell(spark, sf), "session_date", "code")
    return codes.select("session_date", (F.col("code") + 1).alias("timestamp"))


@query(
    f"""
    SELECT article_id, external_id, client_id, CAST(session_date AS VARCHAR) AS session_date, duration,
           CAST(published_at AS VARCHAR) AS published_at, item_id, user_id, "timestamp" FROM ({_PREPARED})
    """,
    "order_dwell order_articles",
)
def prepared_interactions(spark, sf):
    return _prepared(spark, sf)


@query(
    f"SELECT external_id, count(*) AS reads FROM ({_TRAINING}) GROUP BY external_id "
    "ORDER BY reads DESC, external_id LIMIT 1",
    "order_dwell order_articles",
)
def most_read(spark, sf):
    return interactions.most_read_article(_training(spark, sf))


@query(
    f"""
    SELECT external_id, item_id, min(article_id) AS article_id, CAST(max(published_at) AS VARCHAR) AS published_at,
           round(pow(0.5, date_diff('day', max(published_at), DATE '2001-11-04') / 120.0), 6) AS decay
    FROM ({_PREPARED}) GROUP BY external_id, item_id
    """,
    "order_dwell order_articles",
)
def item_dimension(spark, sf):
    return interactions.item_dimension(_prepared(spark, sf), i.ORDER_DAY, 120)


# ------------------------------------------------------------------------- similarity


@query(
    """
    SELECT item_id, round(sqrt(list_dot_product(unit, unit)), 6) AS length, round(unit[1], 6) AS first,
           round(list_sum(unit), 6) AS total
    FROM (SELECT item_id, list_transform(embedding, lambda x: x / sqrt(list_dot_product(embedding, embedding))) AS unit
          FROM item_vectors)
    """,
    "item_vectors",
)
def l2_norm(spark, sf):
    unit = i.item_vectors(spark, sf).select("item_id", vectors.l2_normalise(F.col("embedding")).alias("unit"))
    total = F.aggregate("unit", F.lit(0.0), lambda a, x: a + x)
    return unit.select(
        "item_id", vectors.norm(F.col("unit")).alias("length"), F.get("unit", F.lit(0)).alias("first"), total.alias("total")
    )


@query(
    """
    SELECT a.item_id, round((1 + list_cosine_similarity(a.embedding, b.embedding)) / 2, 6) AS similarity
    FROM item_vectors a JOIN item_vectors b ON b.item_id = a.item_id + 1
    """,
    "item_vectors",
)
def pair_similarity(spark, sf):
    """Every article against the one after it."""
    rows = i.item_vectors(spark, sf)
    after = rows.select((F.col("item_id") - 1).alias("item_id"), F.col("embedding").alias("other"))
    cosine = vectors.cosine(F.col("embedding"), F.col("other"))
    return rows.join(after, "item_id").select("item_id", vectors.unit_similarity(cosine).alias("similarity"))


def _decayed(spark, sf):
    rows = i.item_vectors(spark, sf)
    decay = clock.half_life_decay(i.EVENT_DAY, F.col("published_at"), 30)
    return rows.withColumn("decay", decay)


_KNN = """
    SELECT item_id, neighbour_id, round(score, 6) AS score, position FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, neighbour_id) AS position FROM (
            SELECT a.item_id, b.item_id AS neighbour_id,
                   round((1 + list_cosine_similarity(a.embedding, b.embedding)) / 2
                         * pow(0.5, date_diff('day', b.published_at, DATE '2024-01-30') / 30.0), 9) AS score
            FROM item_vectors a JOIN item_vectors b ON a.item_id <> b.item_id))
    WHERE position <= 10
"""


@query(_KNN, "item_vectors")
def knn_recs(spark, sf):
    """Ten most similar recent articles of every article."""
    return similarity.nearest(_decayed(spark, sf), 10)


@query(_KNN, "item_vectors")
def knn_recs_small_blocks(spark, sf):
    """The same through blocks of 128 rows, which leaves blocks out by their decay."""
    return similarity.nearest(_decayed(spark, sf), 10, block_rows=128)


@query(_KNN.replace("* pow(0.5, date_diff('day', b.published_at, DATE '2024-01-30') / 30.0)", ""), "item_vectors")
def knn_recs_equal_decays(spark, sf):
    """Neighbours by direction alone, through small blocks around eight pivots: blocks are left out by their angle."""
    return similarity.nearest(_decayed(spark, sf).withColumn("decay", F.lit(1.0)), 10, block_rows=64, cells=8)


# ---------------------------------------------------------------- training, evaluation


_ITEMS = f"""
    SELECT dense_rank() OVER (ORDER BY external_id) - 1 AS item_id, CAST(8 AS BIGINT) AS n_factors, {{0}}
    FROM (SELECT DISTINCT external_id FROM ({_TRAINING}))
"""


def _shape(vectors_of, column):
    """Which items have a vector, how long it is, and that all its numbers are usable."""
    usable = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e6))
    return vectors_of.select(
        F.col(vectors_of.columns[0]).alias("item_id"),
        F.size(column).alias("n_factors"),
        usable.cast("bigint").alias("usable"),
    )


@query(_ITEMS.format("CAST(1 AS BIGINT) AS usable"), "order_dwell order_articles")
def als_item_factors(spark, sf):
    """The implicit fit gives every training item a full vector."""
    return _shape(factors.fit_implicit(_prepared(spark, sf), PARAMS).itemFactors, "features")


@query(_ITEMS.format("CAST(1 AS BIGINT) AS usable"), "order_dwell order_articles")
def als_explicit_factors(spark, sf):
    return _shape(factors.fit_explicit(_prepared(spark, sf), PARAMS).itemFactors, "features")


@query(_ITEMS.format("CAST(1 AS DOUBLE) AS length"), "order_dwell order_articles")
def item_embeddings(spark, sf):
    """Embeddings have length one."""
    unit = factors.item_embeddings(factors.fit_implicit(_prepared(spark, sf), PARAMS))
    length = F.round(vectors.norm(F.col("embedding")), 4)
    return unit.select("item_id", F.size("embedding").alias("n_factors"), length.alias("length"))


@query(
    f"""
    SELECT external_id, item_id, min(article_id) AS article_id, CAST(max(published_at) AS VARCHAR) AS published_at,
           round(pow(0.5, date_diff('day', max(published_at), DATE '2001-11-04') / 120.0), 6) AS decay, CAST(8 AS BIGINT) AS n_factors
    FROM ({_PREPARED}) GROUP BY external_id, item_id
    """,
    "order_dwell order_articles",
)
def train_step(spark, sf):
    """Every item of the dimension has its embedding next to it."""
    embeddings, dimension = recommend.train_step(_training(spark, sf), PARAMS, i.ORDER_DAY)
    joined = embeddings.join(dimension, "item_id")
    return joined.withColumn("n_factors", F.size("embedding")).drop("embedding")


_DRAW = "CAST(('0x' || md5(concat_ws('|', '0', client_id, CAST(article_id AS VARCHAR), CAST(session_date AS VARCHAR)))[1:8]) AS BIGINT) % 100"


@query(
    f"""SELECT client_id, article_id, CAST(session_date AS VARCHAR) AS session_date, duration, CAST(1 AS BIGINT) AS n_sides,
               {_DRAW} >= 80 AS held_out FROM order_dwell""",
    "order_dwell",
)
def train_test_split(spark, sf):
    """Every interaction is on exactly one side, and on which."""
    train, test = evaluation.split_interactions(i.order_dwell(spark, sf))
    both = train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))
    return both.groupBy("client_id", "article_id", "session_date", "duration").agg(
        F.count(F.lit(1)).alias("n_sides"), F.bool_or("held_out").alias("held_out")
    )


@query(
    f"""SELECT duration, client_id, article_id, external_id, CAST(published_at AS VARCHAR) AS published_at, site,
               CAST(session_date AS VARCHAR) AS session_date FROM order_dwell WHERE {_DRAW} >= 80""",
    "order_dwell",
)
def held_out_rows(spark, sf):
    """The fifth of the interactions that is held out."""
    return evaluation.split_interactions(i.order_dwell(spark, sf))[1]


_FIXED = """
    users AS (SELECT CAST(vec_id AS INT) AS user_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 2 = 0),
    items AS (SELECT CAST(vec_id AS INT) AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 2 = 1),
    pairs AS (SELECT DISTINCT CAST(l_suppkey AS INT) AS user_id, CAST(l_partkey AS INT) AS item_id FROM lineitem),
    n AS (SELECT count(*) AS n FROM items)
"""


def _fixed_factors(spark, sf):
    vectors_of = i.read(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))
    pairs = i.read(spark, sf, "lineitem").select(F.col("l_suppkey").cast("int").alias("user_id"), F.col("l_partkey").cast("int").alias("item_id"))
    return vectors_of.filter("id % 2 = 0"), vectors_of.filter("id % 2 = 1"), pairs


_RANKS = f"""
    WITH {_FIXED},
    known AS (SELECT p.user_id, p.item_id, u.v, round(list_dot_product(u.v, i.v), 6) AS mine
              FROM pairs p JOIN users u USING (user_id) JOIN items i USING (item_id)),
    judged AS (SELECT k.user_id, k.item_id, count(*) FILTER (WHERE round(list_dot_product(k.v, i.v), 6) > mine AND i.item_id <> k.item_id) AS better,
                      count(*) FILTER (WHERE round(list_dot_product(k.v, i.v), 6) = mine OR i.item_id = k.item_id) AS equal
               FROM known k, items i GROUP BY k.user_id, k.item_id)
    SELECT user_id, item_id, better + (equal + 1) / 2.0 AS rank, FALSE AS cold FROM judged
    UNION ALL
    SELECT user_id, item_id, (n + 1) / 2.0, TRUE FROM pairs, n WHERE user_id NOT IN (SELECT user_id FROM users)
    UNION ALL
    SELECT user_id, item_id, n + 1.0, TRUE FROM pairs, n
    WHERE user_id IN (SELECT user_id FROM users) AND item_id NOT IN (SELECT item_id FROM items)
    """


@query(_RANKS)
def factor_ranks(spark, sf):
    """Ranks from fixed factors: even embeddings are readers, odd ones articles, line items the held-out pairs, many of them cold."""
    return evaluation.factor_ranks(*_fixed_factors(spark, sf))


@query(_RANKS)
def factor_ranks_small_blocks(spark, sf):
    """The same through blocks of 32 articles around four pivots."""
    return evaluation.factor_ranks(*_fixed_factors(spark, sf), block_rows=32, cells=4)


@query(
    f"""
    SELECT user_id, count(*) AS n_ratings, model, TRUE AS solved
    FROM (SELECT DISTINCT user_id, item_id FROM ({_PREPARED})), (SELECT unnest(['implicit', 'explicit']) AS model) GROUP BY user_id, model
    """,
    "order_dwell order_articles",
)
def als_residuals(spark, sf):
    """Every reader's factors solve its normal equations, in both models, up to the single precision they are stored in."""
    prepared = settle(_prepared(spark, sf))
    found = []
    for params in (PARAMS.with_values(alpha=2.0), PARAMS.with_values(implicit=False)):
        model, ratings = factors.fit(prepared, params), factors.rating_table(prepared, params.implicit)
        left = residuals.reader_residuals(model.userFactors, model.itemFactors, ratings, params)
        name = F.lit("implicit" if params.implicit else "explicit").alias("model")
        found.append(left.select("user_id", "n_ratings", name, (F.col("residual") < 1e-4).alias("solved")))
    return found[0].unionByName(found[1])


@query(
    """
    WITH sums AS (SELECT unnest(range(8)) AS i, NULL),
    v AS (SELECT CAST(embedding AS DOUBLE[])[1:8] AS e FROM embeddings)
    SELECT CAST(a.i AS INT) AS i, CAST(b.i AS INT) AS j, round(sum(e[a.i + 1] * e[b.i + 1]), 6) AS x FROM sums a, sums b, v GROUP BY a.i, b.i
    """
)
def gramian(spark, sf):
    """The sum of the outer products of all vectors, first eight numbers each."""
    first = i.read(spark, sf, "embeddings").select(F.slice("embedding", 1, 8).alias("features"))
    found = residuals.gramian(first)
    rows = [(a, b, float(x)) for a, line in enumerate(found.tolist()) for b, x in enumerate(line)]
    return spark.createDataFrame(rows, "i int, j int, x double").withColumn("x", F.round("x", 6))


class _FixedModel:
    """Factors that are no fit but given: even embeddings are readers, odd ones items, cut to the rank."""

    def __init__(self, spark, sf, rank: int):
        found = i.read(spark, sf, "embeddings").select("vec_id", F.slice("embedding", 1, rank).alias("features"))
        self.userFactors = found.filter("vec_id % 2 = 0").select((F.col("vec_id") / 2).cast("int").alias("id"), "features")
        self.itemFactors = found.filter("vec_id % 2 = 1").select(((F.col("vec_id") - 1) / 2).cast("int").alias("id"), "features")


@query(
    """
    SELECT CAST((vec_id - 1) // 2 AS BIGINT) AS item_id, round(e[1] / sqrt(list_dot_product(e, e)), 6) AS first, round(list_sum(e) / sqrt(list_dot_product(e, e)), 6) AS total
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[])[1:8] AS e FROM embeddings WHERE vec_id % 2 = 1)
    """
)
def fixed_embeddings(spark, sf):
    """Embeddings of given factors, number by number."""
    unit = factors.item_embeddings(_FixedModel(spark, sf, 8))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return unit.select("item_id", F.round(F.get("embedding", 0), 6).alias("first"), F.round(total, 6).alias("total"))


@query(
    f"""
    SELECT * FROM (WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    pairs AS (SELECT DISTINCT user_id, item_id FROM (SELECT *, {_DRAW} AS draw FROM ({_PREPARED})) WHERE draw >= 80),
    ranks AS (SELECT combination, 4 * (combination + 1) AS r FROM (SELECT unnest([0, 1, 2]) AS combination)),
    u AS (SELECT combination, vec_id // 2 AS user_id, v[1:r] AS v FROM e, ranks WHERE vec_id % 2 = 0),
    t AS (SELECT combination, (vec_id - 1) // 2 AS item_id, v[1:r] AS v FROM e, ranks WHERE vec_id % 2 = 1),
    n AS (SELECT count(*) AS n FROM e WHERE vec_id % 2 = 1),
    known AS (SELECT u.combination, p.user_id, p.item_id, u.v, round(list_dot_product(u.v, t.v), 6) AS mine
              FROM pairs p JOIN u USING (user_id) JOIN t ON t.item_id = p.item_id AND t.combination = u.combination),
    warm AS (SELECT k.combination, k.user_id, k.item_id, 1 / (count(*) FILTER (WHERE t.item_id <> k.item_id AND round(list_dot_product(k.v, t.v), 6) > mine)
                + (count(*) FILTER (WHERE t.item_id = k.item_id OR round(list_dot_product(k.v, t.v), 6) = mine) + 1) / 2.0) AS gain
             FROM known k JOIN t ON t.combination = k.combination GROUP BY k.combination, k.user_id, k.item_id),
    every AS (
        SELECT c.combination, p.user_id, coalesce(w.gain, CASE WHEN u.user_id IS NULL THEN 2.0 / (n + 1) ELSE 1.0 / (n + 1) END) AS gain, w.gain IS NULL AS cold
        FROM pairs p CROSS JOIN (SELECT combination FROM ranks) c CROSS JOIN n LEFT JOIN warm w ON w.combination = c.combination AND w.user_id = p.user_id AND w.item_id = p.item_id
        LEFT JOIN (SELECT DISTINCT user_id FROM u) u ON u.user_id = p.user_id),
    own AS (SELECT combination, user_id, avg(gain) AS gain, count(*) AS n_pairs, count(*) FILTER (WHERE cold) AS n_cold FROM every GROUP BY ALL)
    SELECT CAST(combination AS INT) AS combination, round(avg(gain), 6) AS mrr, CAST(sum(n_pairs) AS BIGINT) AS n_pairs, CAST(sum(n_cold) AS BIGINT) AS n_cold FROM own GROUP BY combination)
    """,
    "order_dwell order_articles",
)
def grid_search_fixed(spark, sf):
    """Three ranks of given factors: the mean reciprocal rank of each combination, exactly."""
    tuned = PARAMS.with_values(tune_ranges={"rank": (4, 13, 4)})
    results = factors.grid_search(settle(_prepared(spark, sf)), tuned, lambda _, params: _FixedModel(spark, sf, params.rank))[0]
    return results.select("combination", F.round("mrr", 6).alias("mrr"), "n_pairs", "n_cold")


_DIMENSION = f"""(SELECT external_id, item_id, min(article_id) AS article_id, pow(0.5, date_diff('day', max(published_at), DATE '2001-11-04') / 120.0) AS decay
    FROM ({_PREPARED}) GROUP BY external_id, item_id)"""


@query(
    f"""
    SELECT source_entity_id, recommended_article_id, CAST(CAST(round(score, 6) AS DECIMAL(7,6)) AS DOUBLE) AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY source_entity_id ORDER BY score DESC, neighbour) AS position FROM (
            SELECT a.external_id AS source_entity_id, b.article_id AS recommended_article_id, b.item_id AS neighbour,
                   round((1 + list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[]))) / 2 * b.decay, 9) AS score
            FROM {_DIMENSION} a JOIN embeddings x ON x.vec_id = a.item_id, {_DIMENSION} b JOIN embeddings y ON y.vec_id = b.item_id
            WHERE a.item_id <> b.item_id))
    WHERE position <= 10
    """,
    "order_dwell order_articles",
)
def article_recs_fixed(spark, sf):
    """Recommendations of given embeddings, row by row."""
    embeddings = i.read(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("item_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    dimension = interactions.item_dimension(settle(_prepared(spark, sf)), i.ORDER_DAY, 120)
    return recommend.recs_from_embeddings(embeddings, dimension, 10)


@query(
    f"""
    SELECT unnest([0, 1, 2, 3]) AS combination, n_pairs, TRUE AS judged
    FROM (SELECT count(*) AS n_pairs FROM (SELECT DISTINCT user_id, item_id FROM
          (SELECT *, {_DRAW} AS draw FROM ({_PREPARED})) WHERE draw >= 80))
    """,
    "order_dwell order_articles",
)
def grid_search_pairs(spark, sf):
    """Every combination is judged on all held-out pairs."""
    tuned = PARAMS.with_values(tune_ranges={"iterations": (1, 3, 1), "rank": (4, 9, 4)})
    results = factors.grid_search(settle(_prepared(spark, sf)), tuned)[0]
    return results.select("combination", "n_pairs", F.col("mrr").between(0, 1).alias("judged"))


@query()
def grid_search(spark, sf):
    """Two by two parameter values, judged by MRR on held-out interactions."""
    tuned = PARAMS.with_values(tune_ranges={"iterations": (1, 3, 1), "rank": (4, 9, 4)})
    return factors.grid_search(settle(_prepared(spark, sf)), tuned)[0]


@query()
def article_recs(spark, sf):
    return recommend.article_recs_from(_training(spark, sf), PARAMS, i.ORDER_DAY)


_RANKED = """
    SELECT user_id, item_id, returned,
           rank() OVER (PARTITION BY user_id ORDER BY score DESC) + (count(*) OVER (PARTITION BY user_id, score) - 1) / 2.0
               AS rank
    FROM (SELECT l_suppkey AS user_id, l_partkey AS item_id, round(sum(l_quantity)) AS score,
                 bool_or(l_returnflag = 'R') AS returned
          FROM lineitem GROUP BY l_suppkey, l_partkey)
"""


def _ranks(spark, sf):
    """Parts scored for their supplier by quantity, with many ties; returned ones are held out."""
    lines = (
        i.read(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(
            F.round(F.sum("l_quantity")).alias("score"),
            F.bool_or(F.col("l_returnflag") == "R").alias("returned"),
        )
    )
    lines = settle(lines)
    return evaluation.ranks(lines.drop("returned"), lines.filter("returned"))


@query(f"SELECT user_id, item_id, round(rank, 6) AS rank FROM ({_RANKED}) WHERE returned")
def mrr_ranks(spark, sf):
    return _ranks(spark, sf).drop("score")


@query(
    f"""
    SELECT round(avg(m), 6) AS mrr, count(*) AS users
    FROM (SELECT user_id, avg(1.0 / rank) AS m FROM ({_RANKED}) WHERE returned GROUP BY user_id)
    """
)
def mrr(spark, sf):
    return evaluation.mrr(_ranks(spark, sf))


@query(
    f"""
    SELECT external_id AS source_entity_id, least(10, count(*) OVER () - 1) AS n_recs, CAST(0 AS BIGINT) AS n_self
    FROM (SELECT DISTINCT external_id FROM ({_TRAINING}))
    """,
    "order_dwell order_articles",
)
def article_recs_coverage(spark, sf):
    """Every trained article gets its recommendations and none is itself."""
    recs = recommend.article_recs_from(_training(spark, sf), PARAMS, i.ORDER_DAY)
    own = F.concat(F.lit("p"), F.col("recommended_article_id").cast("string")) == F.col("source_entity_id")
    return recs.groupBy("source_entity_id").agg(
        F.count(F.lit(1)).alias("n_recs"), F.count_if(own).alias("n_self")
    )
