"""Article table maintenance: pure functions from a snapshot and changes to a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.functions.clock import as_timestamp
from pressroom.operators.ordering import numbered
from pressroom.operators.skew import lookup_join

COLUMNS = ["id", "site", "external_id", "title", "path", "published_at", "created_at", "updated_at"]
KEY = ["site", "external_id"]
ERROR_COLUMNS = ["site", "path", "external_id", "error_type", "msg"]


def known_ids(candidates: DataFrame, articles: DataFrame) -> DataFrame:
    return lookup_join(candidates, articles.select(*KEY), KEY, "left_semi")


def unknown_ids(candidates: DataFrame, articles: DataFrame) -> DataFrame:
    return lookup_join(candidates, articles.select(*KEY), KEY, "left_anti")


def articles_by_path(articles: DataFrame, paths: DataFrame) -> DataFrame:
    return lookup_join(articles, paths.select("site", "path"), ["site", "path"], "left_semi")


def first_path_per_id(extracted: DataFrame) -> DataFrame:
    """The alphabetically first path of each id, as a partial minimum."""
    return extracted.groupBy(*KEY).agg(F.min("path").alias("path"))


def new_articles(extracted: DataFrame, articles: DataFrame) -> DataFrame:
    """Ids not stored yet, each with the one path that creates it."""
    good = extracted.filter(F.col("error_type").isNull())
    return first_path_per_id(unknown_ids(good, articles)).select("site", "path", "external_id")


def duplicate_paths(extracted: DataFrame, articles: DataFrame) -> DataFrame:
    """Paths whose id is stored already or is created by another path."""
    good = extracted.filter(F.col("error_type").isNull()).select("site", "path", "external_id")
    creating = new_articles(extracted, articles)
    others = good.join(creating, ["site", "path", "external_id"], "left_anti")
    return others.withColumn("error_type", F.lit("duplicate_path")).withColumn("msg", F.lit(""))


def _undated(scraped: DataFrame) -> DataFrame:
    return scraped.filter(F.col("error_type").isNull() & F.col("published_at").isNull()).select(
        "site", "path", "external_id", F.lit("no_publish_date").alias("error_type"), F.lit("").alias("msg")
    )


def failed_scrapes(scraped: DataFrame) -> DataFrame:
    return scraped.filter(F.col("error_type").isNotNull()).select(*ERROR_COLUMNS)


def scrape_errors(*errors: DataFrame) -> DataFrame:
    """All failures of a run in one table."""
    whole = errors[0].select(*ERROR_COLUMNS)
    for more in errors[1:]:
        whole = whole.unionByName(more.select(*ERROR_COLUMNS))
    return whole


def _with_new_ids(rows: DataFrame, articles: DataFrame, first_id: int | None = None) -> DataFrame:
    """Ids from ``first_id`` on, or after the largest stored id, in key order."""
    if first_id is not None:
        return numbered(rows, [F.col(c) for c in KEY], "_n").withColumn("id", F.col("_n") + F.lit(first_id).cast("long")).drop("_n")
    last = articles.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    return numbered(rows, [F.col(c) for c in KEY], "_n").withColumn("id", last + F.col("_n") + 1).drop("_n")


def create_articles(
    articles: DataFrame, scraped: DataFrame, as_of, first_id: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new snapshot, created rows, errors of undated articles).

    ``scraped`` comes from ``extract_metadata`` on new articles; ids already stored are
    left alone. ``first_id`` begins a range reserved for the new ones.
    """
    dated = scraped.filter(F.col("error_type").isNull() & F.col("published_at").isNotNull())
    fresh = unknown_ids(dated, articles).select(
        *KEY, F.coalesce("title", F.lit("")).alias("title"), F.col("new_path").alias("path"), "published_at"
    )
    stamp = as_timestamp(as_of)
    created = (
        _with_new_ids(fresh, articles, first_id).withColumn("created_at", stamp).withColumn("updated_at", stamp)
    ).select(*COLUMNS)
    return articles.select(*COLUMNS).unionByName(created), created, _undated(scraped)


def refresh_articles(articles: DataFrame, scraped: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, errors of undated results). Dated results overwrite everything but
    ``id`` and ``created_at``."""
    changes = scraped.filter(F.col("error_type").isNull() & F.col("published_at").isNotNull()).select(
        *KEY,
        F.col("title").alias("_title"),
        F.col("new_path").alias("_path"),
        F.col("published_at").alias("_published"),
        F.lit(True).alias("_changed"),
    )
    merged = articles.join(changes, KEY, "left")
    snapshot = merged.select(
        "id",
        *KEY,
        F.coalesce("_title", "title").alias("title"),
        F.coalesce("_path", "path").alias("path"),
        F.coalesce("_published", "published_at").alias("published_at"),
        "created_at",
        F.when(F.col("_changed"), as_timestamp(as_of)).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    return snapshot, _undated(scraped)


def delete_excluded_articles(articles: DataFrame, errors: DataFrame, message: str) -> DataFrame:
    """Drop articles whose refresh ended with ``message``."""
    gone = errors.filter(F.col("msg") == message).select(*KEY)
    return articles.join(gone, KEY, "left_anti").select(*COLUMNS)


def upsert_articles(articles: DataFrame, bulk: DataFrame, as_of, first_id: int | None = None) -> DataFrame:
    """Update by (site, external_id) or insert; of several rows for one key the one with
    the latest publish date counts."""
    incoming = (
        bulk.filter(F.col("external_id").isNotNull())
        .groupBy(*KEY)
        .agg(F.max(F.struct("published_at", "title", "path")).alias("_new"))
    )
    stamp = as_timestamp(as_of)
    merged = articles.join(incoming, KEY, "full")
    whole = merged.select(
        "id",
        *KEY,
        F.coalesce("_new.title", "title", F.lit("")).alias("title"),
        F.coalesce("_new.path", "path", F.lit("")).alias("path"),
        F.coalesce("_new.published_at", "published_at").alias("published_at"),
        F.coalesce("created_at", stamp).alias("created_at"),
        F.when(F.col("_new").isNotNull(), stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    inserted = _with_new_ids(whole.filter(F.col("id").isNull()).drop("id"), articles, first_id)
    return whole.filter(F.col("id").isNotNull()).unionByName(inserted.select(*COLUMNS)).select(*COLUMNS)
