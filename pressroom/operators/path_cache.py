"""Path cache: which path belongs to which article, and which paths to leave alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions.clock import as_timestamp

COLUMNS = ["site", "path", "external_id", "exclude_reason", "created_at", "updated_at"]

_EXCLUDED, _ADDED, _STORED = 0, 1, 2  # which row of a path wins


def path_entries(created: DataFrame, errors: DataFrame) -> DataFrame:
    """Cache rows a run adds.

    ``created(site, path, new_path, external_id)`` are created articles with the visited and
    the canonical path: both get an entry. Failures that exclude a path are stored with
    their reason, duplicates point at the article that is there; other failures leave no
    trace, so the path is tried again.
    """
    no_text = F.lit(None).cast("string")
    excluded = errors.filter(F.col("error_type").isin(*config.EXCLUDING_FAILURES)).select(
        "site",
        "path",
        no_text.alias("external_id"),
        F.col("error_type").alias("exclude_reason"),
        F.lit(_EXCLUDED).alias("_rank"),
    )
    aliases = errors.filter(F.col("error_type") == "duplicate_path").select(
        "site", "path", "external_id", no_text.alias("exclude_reason"), F.lit(_ADDED).alias("_rank")
    )
    both = created.select(
        "site", F.explode(F.array_distinct(F.array("path", "new_path"))).alias("path"), "external_id"
    )
    articles = both.filter(F.col("path").isNotNull()).select(
        "site", "path", "external_id", no_text.alias("exclude_reason"), F.lit(_ADDED).alias("_rank")
    )
    return excluded.unionByName(aliases).unionByName(articles)


def update_path_cache(paths: DataFrame, created: DataFrame, errors: DataFrame, as_of) -> DataFrame:
    """One row per (site, path); an exclusion wins, then this run's rows, then stored ones."""
    stored = paths.select(
        "site",
        "path",
        "external_id",
        "exclude_reason",
        F.when(F.col("exclude_reason").isNotNull(), _EXCLUDED).otherwise(_STORED).alias("_rank"),
        "created_at",
        "updated_at",
    )
    stamp = as_timestamp(as_of)
    added = path_entries(created, errors)
    added = added.withColumn("created_at", stamp).withColumn("updated_at", stamp)
    everything = stored.unionByName(added)
    # a partial minimum, so repeated entries of one path are reduced before the shuffle
    best = F.min(F.struct("_rank", "created_at", "external_id", "exclude_reason", "updated_at"))
    merged = everything.groupBy("site", "path").agg(
        best.alias("_best"), F.min("created_at").alias("_first")
    )
    return merged.select(
        "site",
        "path",
        "_best.external_id",
        "_best.exclude_reason",
        F.col("_first").alias("created_at"),
        "_best.updated_at",
    )
