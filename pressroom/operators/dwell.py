"""Reader dwell time per article and day."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom import config
from pressroom.operators.skew import key_counts, lookup_join

COLUMNS = ["duration", "client_id", "article_id", "external_id", "published_at", "site", "session_date"]


def dwell_times(
    events: DataFrame,
    articles: DataFrame,
    site: str | None = None,
    dates=None,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """``sum(ping_count) * 10`` seconds per reader, article and session date.

    Pings are summed per path before the join, so what a hot path sends through the join
    is one row per reader and day. ``aliases`` (a path cache) also credits other paths of
    an article; by default only its own path counts.
    """
    pings = events.filter(F.col("event_name") == config.PAGE_PING)
    if site is not None:
        pings = pings.filter(F.col("site") == site)
        articles = articles.filter(F.col("site") == site)
    if dates is not None:
        # dates and chunks come from the same moment; the chunk is what the table is partitioned by
        days = [F.col("chunk_name").between(f"{day:%Y/%m/%d}/00", f"{day:%Y/%m/%d}/23") for day in dates]
        pings = pings.filter(F.col("session_date").isin(list(dates)) & reduce(or_, days, F.lit(False)))
    per_path = pings.groupBy("site", "landing_page_path", "client_id", "session_date").agg(
        F.sum("ping_count").alias("_pings")
    )
    by_path = articles.select(
        "site",
        F.col("path").alias("landing_page_path"),
        F.col("id").alias("article_id"),
        "external_id",
        F.col("published_at").cast("date").alias("published_at"),
    )
    if aliases is not None:
        alias_paths = aliases.select("site", F.col("path").alias("landing_page_path"), "external_id")
        alias_rows = alias_paths.join(by_path.drop("landing_page_path"), ["site", "external_id"])
        by_path = by_path.unionByName(alias_rows.select(*by_path.columns)).distinct()
    # the raw pings say which paths are hot without shuffling the sums a second time
    key = ["site", "landing_page_path"]
    joined = lookup_join(per_path, by_path, key, counts=key_counts(pings, key))
    if aliases is not None:
        joined = joined.groupBy(
            "session_date", "client_id", "article_id", "site", "external_id", "published_at"
        ).agg(F.sum("_pings").alias("_pings"))
    # without aliases an article has one path, so (article, reader, day) is already unique
    seconds = F.col("_pings") * F.lit(config.SECONDS_PER_PING)
    return joined.withColumn("duration", seconds.cast("bigint")).select(*COLUMNS)
