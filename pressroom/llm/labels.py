"""Folds and bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier learns from at most.
SAMPLE_ROWS = 20_000


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % folds


def held_out(folds: int, out: int) -> Column:
    """Whether a document is in the fold nobody learns from. A null id has no label and isn't held out."""
    return F.coalesce(fold("doc_id", folds) == out, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, out: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, text, label)``: at most ``rows`` rows, one for each labelled id outside the held-out fold, the ids chosen by a hash.

    An id with several labels has their mean, rounded up; null labels don't count. Of several rows with one id the text with the smallest hash counts, however many they are.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & (fold("doc_id", folds) != out))
        .groupBy("doc_id")
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("hash", F.xxhash64("text"))  # rows are bounded
    return found.groupBy("doc_id").agg(F.min_by("text", F.struct("hash", "text")).alias("text"), F.any_value("label").alias("label"))
