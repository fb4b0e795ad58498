"""Quality scores by Bradley-Terry pairwise ranking.

Of two labelled texts the better one should win: its chance is the logistic function of the difference of two linear scores. The weights
are fitted on the differences of the features of (better, worse) pairs; what is rejected follows from a quantile of the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import features, labels, words

#: Preference pairs the weights are fitted on, and the score that the rejecting quantile is mapped to.
PAIRS, CUT = 100_000, 0.3
FOLDS, HELD_OUT = 5, 0
#: Strength of the pull of weights to zero.
RIDGE = 1e-3


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, rising with the raw score; the threshold gives ``CUT``."""
        z = np.clip(self.raw(x) - self.threshold + np.log(CUT / (1 - CUT)), -500, 500)
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Ranking:
    """Weights from preference pairs, and the score quantile that separates the labels best.

    With labels of one kind only, nothing can be compared: all weights are zero and every text scores above the cut.
    """
    mean, scale = (x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    model = Ranking(mean, scale, np.zeros(x.shape[1]), -4.0)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(better) or not len(worse):
        return model
    random = np.random.default_rng(seed)
    z = np.clip((x - mean) / scale, -8, 8)
    difference = z[random.choice(better, PAIRS)] - z[random.choice(worse, PAIRS)]
    # Newton's method on the logistic loss of the differences
    for _ in range(12):
        p = 1 / (1 + np.exp(np.clip(difference @ model.weights, -30, 30)))  # chance that the worse one wins
        gradient = difference.T @ p / PAIRS - RIDGE * model.weights
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / PAIRS + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        model.weights = model.weights + step
        if np.abs(step).max() < 1e-6:
            break
    raw = model.raw(x)
    cuts = np.quantile(raw, np.linspace(0, 1, 401)[1:-1])
    errors = [np.sum((raw >= c) != (y == 1)) for c in cuts]
    best = np.flatnonzero(errors == np.min(errors))
    model.threshold = float(cuts[best[0]])  # of equal ones the lowest: it rejects least
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in words.pieces(batches, "text"):
        x = features.dense(piece.column(piece.schema.get_field_index("text")))
        lists = words.list_array(x.ravel(), np.arange(len(x) + 1) * x.shape[1], pa.float64())
        yield pa.RecordBatch.from_arrays([piece.column("label"), lists], ["label", "x"])


def train(docs: DataFrame, label_rows: DataFrame, label: str = "quality") -> Ranking:
    """Fit on a bounded sample of labelled texts outside the held-out fold."""
    sample = labels.training_sample(docs, label_rows, label, FOLDS, HELD_OUT).select("text", "label")
    rows = sample.mapInArrow(_feature_rows, "label int, x array<double>").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(features.NAMES))
    y = rows.column("label").to_numpy()
    order = np.lexsort((*x.T, y))  # the order in which rows arrive doesn't matter
    return fit(x[order], y[order])


def _scores(model: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            score = model.score(features.dense(piece.column(piece.schema.get_field_index("text"))))
            kept = [c for c in piece.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), pa.array(score)], [*kept, "score"])

    return run


def _kept(model: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            score = model.score(features.dense(piece.column(piece.schema.get_field_index("text"))))
            yield piece.filter(pa.array(score >= CUT))

    return run


def keep_good(docs: DataFrame, label_rows: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the cut."""
    return docs.mapInArrow(_kept(train(docs, label_rows)), docs.schema)


def quality_scores(docs: DataFrame, label_rows: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` and ``label_rows (doc_id, quality)`` to ``(doc_id, held_out, score, predicted)``, one row for
    each row of ``docs``.

    Null and empty texts have the features of a text without words and a score like any other. Ids without labels, repeated ids and null
    ids are scored too; other columns are ignored. Without labels of both kinds every text is kept. An empty table gives no rows.
    """
    model = train(docs, label_rows)
    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scores(model), "doc_id long, score double")
    return scored.select("doc_id", labels.held_out(FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
