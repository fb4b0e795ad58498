"""How well fitted factors solve the equations they come from.

Alternating least squares solves the readers last, with the items fixed: each reader's vector x is the solution of its regularised normal equations
``A x = b``. What is left of them tells whether ratings, regularisation and confidence entered the fit as they should.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.config import TrainingParams
from pressroom.operators.index import matrix
from pressroom.operators.skew import key_counts, lookup_join


def gramian(factors: DataFrame, vector: str = "features") -> np.ndarray:
    """The sum of the outer products of all vectors. Each task sums its own; the driver gets rank x rank numbers."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                rows = matrix(batch[vector])
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "line": list(total)})

    lines = factors.select(vector).mapInPandas(partial, "i int, line array<double>")
    cells = lines.select("i", F.posexplode("line").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    size = 1 + max((r["i"] for r in cells), default=-1)
    out = np.zeros((size, size))
    for r in cells:
        out[r["i"], r["j"]] = r["x"]
    return out


def reader_residuals(user_factors: DataFrame, item_factors: DataFrame, ratings: DataFrame, params: TrainingParams) -> DataFrame:
    """Per reader with factors: ``n_ratings`` and ``residual``, the length of ``A x - b`` against that of ``b``.

    ``ratings(user_id, item_id, rating)`` has one row for each pair, as ``factors.rating_table`` gives it. The implicit model weighs a pair by
    1 + alpha x rating and everything else by 1, which is the Gramian of all items; the explicit model knows rated pairs only. Products are summed within
    tasks before readers meet, so a reader with very many ratings is summed by many tasks.
    """
    confidence = params.alpha if params.implicit else None
    rank = params.rank
    users = user_factors.select(F.col("id").alias("user_id"), F.col("features").alias("x"))
    items = item_factors.select(F.col("id").alias("item_id"), F.col("features").alias("y"))
    met = lookup_join(ratings, items, ["item_id"], counts=key_counts(ratings, ["item_id"]))
    met = lookup_join(met, users, ["user_id"], counts=key_counts(ratings, ["user_id"]))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x, y, rating = matrix(batch["x"]), matrix(batch["y"]), batch["rating"].to_numpy(np.float64)
            product = (x * y).sum(axis=1)
            if confidence is None:
                left, right = product, rating
            else:
                weight = confidence * np.abs(rating)
                left, right = weight * product, np.where(rating > 0, 1 + weight, 0.0)
            code, keys = pd.factorize(batch["user_id"])
            sums = np.zeros((2, len(keys), rank))
            np.add.at(sums[0], code, left[:, None] * y)
            np.add.at(sums[1], code, right[:, None] * y)
            number = np.bincount(code, rating > 0 if confidence is not None else np.ones(len(code)), len(keys))
            yield pd.DataFrame({"user_id": keys, "left": list(sums[0]), "right": list(sums[1]), "n": number.astype(np.int64)})

    parts = met.mapInPandas(partial, "user_id int, left array<double>, right array<double>, n long")
    counted = parts.groupBy("user_id").agg(F.sum("n").alias("n_ratings"))
    pairs = parts.select("user_id", F.posexplode(F.arrays_zip("left", "right")).alias("i", "z"))
    summed = pairs.groupBy("user_id", "i").agg(F.sum("z.left").alias("left"), F.sum("z.right").alias("right"))
    lines = summed.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("i", "left", "right"))).alias("lines"))
    whole = gramian(item_factors) if params.implicit else np.zeros((rank, rank))
    penalty = params.regularisation

    @F.pandas_udf("double")
    def left_over(x: pd.Series, lines: pd.Series, n: pd.Series) -> pd.Series:
        solution = matrix(x)
        left = np.array([[z["left"] for z in row] for row in lines])
        right = np.array([[z["right"] for z in row] for row in lines])
        rest = left + solution @ whole + penalty * n.to_numpy()[:, None] * solution - right
        return pd.Series(np.linalg.norm(rest, axis=1) / np.maximum(np.linalg.norm(right, axis=1), 1e-300))

    # as many lines for a reader as the factors have numbers
    joined = users.join(lines, "user_id").join(counted, "user_id")
    return joined.select("user_id", "n_ratings", left_over("x", "lines", "n_ratings").alias("residual"))
