"""Model registry: which model's recommendations are served."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions.clock import as_timestamp
from pressroom.operators.skew import lookup_join

COLUMNS = ["id", "type", "status", "site", "created_at", "updated_at"]


def next_model_id(models: DataFrame) -> int:
    return models.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).first()[0]


def register_model(models: DataFrame, model_id: int, model_type: str, site: str, as_of) -> DataFrame:
    """The registry with one more, pending, model."""
    if model_type not in config.MODEL_TYPES:
        raise ValueError(f"unknown model type {model_type!r}")
    stamp = as_timestamp(as_of)
    row = models.sparkSession.range(1).select(
        F.lit(model_id).cast("bigint").alias("id"),
        F.lit(model_type).alias("type"),
        F.lit("pending").alias("status"),
        F.lit(site).alias("site"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )
    return models.select(*COLUMNS).unionByName(row)


def promote_models(
    models: DataFrame, promoted: DataFrame, as_of, max_deletes: int = config.MAX_STALE_DELETES
) -> DataFrame:
    """Make each model of ``promoted(id, type, site)`` the current one of its type and site.

    The previous current model turns stale, and of the models that were stale before, the
    ``max_deletes`` with the lowest ids go. Other types and sites are untouched.
    """
    groups = promoted.select("type", "site", F.col("id").alias("_new_id"))
    marked = lookup_join(models.select(*COLUMNS), groups, ["type", "site"], "left")
    oldest = W.partitionBy("type", "site").orderBy("id")
    gone = (
        marked.filter(F.col("_new_id").isNotNull() & (F.col("status") == "stale"))
        .select("id", "type", "site")
        .withColumn("_n", F.row_number().over(oldest))
        .filter(F.col("_n") <= max_deletes)
        .select("id")
    )
    is_new = F.col("id") == F.col("_new_id")
    was_current = F.col("_new_id").isNotNull() & (F.col("status") == "current")
    status = F.when(is_new, F.lit("current")).when(was_current, F.lit("stale")).otherwise(F.col("status"))
    changed = is_new | was_current
    return (
        marked.join(gone, "id", "left_anti")
        .withColumn("updated_at", F.when(changed, as_timestamp(as_of)).otherwise(F.col("updated_at")))
        .withColumn("status", status)
        .select(*COLUMNS)
    )


def promote_model(
    models: DataFrame, model_id: int, model_type: str, site: str, as_of, max_deletes=config.MAX_STALE_DELETES
) -> DataFrame:
    new = models.filter(F.col("id") == model_id).select(
        "id", F.lit(model_type).alias("type"), F.lit(site).alias("site")
    )
    return promote_models(models, new, as_of, max_deletes)


def live_recs(recs: DataFrame, models: DataFrame) -> DataFrame:
    """Recommendations whose model is still registered."""
    ids = models.select(F.col("id").alias("model_id"))
    return lookup_join(recs, ids, ["model_id"], "left_semi")


def served_recs(recs: DataFrame, models: DataFrame, model_type: str, site: str) -> DataFrame:
    """Recommendations of the current model of one type and site."""
    current = models.filter(
        (F.col("status") == "current") & (F.col("type") == model_type) & (F.col("site") == site)
    )
    return live_recs(recs, current)
