"""Which visited paths need metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.functions import clock
from pressroom.functions.text import starts_with_any
from pressroom.operators.events import distinct_paths
from pressroom.operators.skew import key_counts, lookup_join


def needs_scrape(as_of):
    """Not excluded, and unknown, undated or published within the last day."""
    published = F.col("published_at")
    recent = published > clock.as_timestamp(F.date_sub(clock.as_date(as_of), 1))
    return F.col("exclude_reason").isNull() & (
        F.col("external_id").isNull() | published.isNull() | recent
    )


def paths_to_update(
    events: DataFrame, paths: DataFrame, articles: DataFrame, as_of, chunks=None, site: str | None = None
) -> DataFrame:
    """Distinct visited paths, looked up in the path cache and then in the articles.

    ``chunks`` is a list of hour names or None for all; ``site`` None means every site.
    """
    visited = events
    if site is not None:
        visited = visited.filter(F.col("site") == site)
        paths = paths.filter(F.col("site") == site)
        articles = articles.filter(F.col("site") == site)
    if chunks is not None:
        visited = visited.filter(F.col("chunk_name").isin(list(chunks)))
    visited = distinct_paths(visited.filter(F.col("landing_page_path").isNotNull()))
    cache = paths.select(
        "site", F.col("path").alias("landing_page_path"), "external_id", "exclude_reason"
    )
    dates = articles.select("site", "external_id", "published_at")
    # every visited path is one row, so only the second join can meet a hot key: an article
    # with many paths, or the paths nobody knows yet
    known = visited.join(cache, ["site", "landing_page_path"], "left")
    key = ["site", "external_id"]
    dated = lookup_join(known, dates, key, "left", counts=key_counts(cache, key))
    return dated.filter(needs_scrape(as_of)).select("site", "landing_page_path", "external_id")


def new_paths(to_update: DataFrame) -> DataFrame:
    return to_update.filter(F.col("external_id").isNull()).select("site", "landing_page_path").distinct()


def refresh_ids(to_update: DataFrame) -> DataFrame:
    return to_update.filter(F.col("external_id").isNotNull()).select("site", "external_id").distinct()


def split_by_prefix(df: DataFrame, column: str, prefixes) -> tuple[DataFrame, DataFrame]:
    """(rows whose path may be an article, rows starting with an excluded prefix)."""
    excluded = F.coalesce(starts_with_any(F.col(column), prefixes), F.lit(False))
    return df.filter(~excluded), df.filter(excluded)
