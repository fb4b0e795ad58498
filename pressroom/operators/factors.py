"""Matrix factorisation of the interactions, and what is read off it."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.config import TrainingParams
from pressroom.functions.vectors import l2_normalise
from pressroom.operators.evaluation import factor_mrr, split_interactions
from pressroom.session import checkpoint_dir, settle


# user and item vectors are exchanged between all pairs of blocks, so blocks are large
RATINGS_PER_BLOCK = 1_000_000
MIN_BLOCKS = 4


def rating_table(prepared: DataFrame, implicit: bool) -> DataFrame:
    """One row per reader and item, summed map-side before any shuffle.

    The implicit model counts visits and ignores how long they lasted; the explicit model
    fits the seconds.
    """
    value = F.count(F.lit(1)) if implicit else F.sum("duration")
    return prepared.groupBy("user_id", "item_id").agg(value.cast("float").alias("rating"))


def fit(prepared: DataFrame, params: TrainingParams) -> ALSModel:
    checkpoint_dir(prepared.sparkSession)
    ratings = settle(rating_table(prepared, params.implicit))
    blocks = max(MIN_BLOCKS, ratings.count() // RATINGS_PER_BLOCK)
    als = ALS(
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        rank=params.rank,
        maxIter=params.iterations,
        regParam=params.regularisation,
        alpha=params.alpha,
        implicitPrefs=params.implicit,
        seed=params.seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=2,
        intermediateStorageLevel="MEMORY_AND_DISK",
        finalStorageLevel="MEMORY_AND_DISK",
    )
    return als.fit(ratings)


def fit_implicit(prepared: DataFrame, params: TrainingParams) -> ALSModel:
    return fit(prepared, params.with_values(implicit=True))


def fit_explicit(prepared: DataFrame, params: TrainingParams) -> ALSModel:
    return fit(prepared, params.with_values(implicit=False))


def item_embeddings(model: ALSModel) -> DataFrame:
    """One unit-length vector per item."""
    vector = F.transform("features", lambda x: x.cast("double"))
    return model.itemFactors.select(
        F.col("id").cast("bigint").alias("item_id"), l2_normalise(vector).alias("embedding")
    )


def grid(tune_ranges: dict) -> list[dict]:
    """Every combination of the half-open stepped ranges."""
    if not tune_ranges:
        raise ValueError("tuning needs at least one parameter range")
    axes = []
    for name, bounds in tune_ranges.items():
        if name not in TrainingParams.__dataclass_fields__:
            raise ValueError(f"unknown training parameter {name!r}")
        if len(bounds) != 3 or not len(range(*bounds)):
            raise ValueError(f"range of {name!r} is not (start, stop, step) with a value in it")
        axes.append([(name, value) for value in range(*bounds)])
    return [dict(combination) for combination in itertools.product(*axes)]


def grid_search(
    prepared: DataFrame, params: TrainingParams, fitter: Callable[[DataFrame, TrainingParams], ALSModel] | None = None
) -> tuple[DataFrame, TrainingParams]:
    """Fit every combination on 80 % of the interactions, score it by MRR on the rest. ``fitter`` may be another
    model than ``fit``; what it returns has ``userFactors`` and ``itemFactors``.

    Returns one row per combination and the best parameters (ties: the earlier one). The
    driver keeps one number per combination.
    """
    train, test = split_interactions(prepared)
    train, test = settle(train), settle(test)
    rows, best, best_mrr = [], None, float("-inf")
    for number, values in enumerate(grid(params.tune_ranges)):
        candidate = params.with_values(**values)
        model = (fitter or fit)(train, candidate)
        value, pairs, cold = factor_mrr(model.userFactors, model.itemFactors, test)
        rows.append((number, {name: float(v) for name, v in values.items()}, value, pairs, cold))
        if value is not None and value > best_mrr:
            best, best_mrr = candidate, value
    schema = "combination int, params map<string,double>, mrr double, n_pairs long, n_cold long"
    results = prepared.sparkSession.createDataFrame(rows, schema)
    return results, best or params


def train(prepared: DataFrame, params: TrainingParams) -> ALSModel:
    """Fit on everything, after choosing the parameters if tuning is on."""
    if params.tune:
        params = grid_search(prepared, params)[1]
    return fit(prepared, params)
