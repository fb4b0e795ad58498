"""Most-read articles with time decay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions import clock, vectors


def popularity(dwell: DataFrame, as_of, days: int, site: str | None = None, limit=config.POPULARITY_LIMIT) -> DataFrame:
    """Top articles by total dwell over the last ``days`` days."""
    rows = dwell.filter(clock.last_n_days(F.col("session_date"), as_of, days))
    if site is not None:
        rows = rows.filter(F.col("site") == site)
    totals = rows.groupBy("article_id").agg(
        F.max("published_at").alias("publish_date"),
        F.sum("duration").alias("score"),
        F.count_distinct("client_id").alias("n_users"),
    )
    return totals.orderBy(F.col("score").desc(), F.col("article_id")).limit(limit)


def time_decay(
    df: DataFrame, as_of, half_life: float, date_col: str = "session_date", value_col: str = "duration"
) -> DataFrame:
    """Multiply ``value_col`` by the half-life decay of ``date_col``."""
    is_date = dict(df.dtypes)[date_col] == "date"
    decay = clock.half_life_decay(as_of, F.col(date_col), half_life, is_date)
    return df.withColumn(value_col, F.col(value_col) * decay)


def normalise_by_max(df: DataFrame, column: str) -> DataFrame:
    """Divide by the global maximum, a scalar subquery (one row, no join)."""
    top = df.agg(F.max(column).alias("top")).scalar()
    return df.withColumn(column, F.try_divide(F.col(column), top))


def popularity_recs(
    dwell: DataFrame,
    as_of,
    days: int,
    site: str | None = None,
    half_life: float = config.POPULARITY_HALF_LIFE,
    limit: int = config.POPULARITY_LIMIT,
    max_recs: int | None = None,
) -> DataFrame:
    """Default recommendations: popularity, decayed by age, scaled to a best score of 1.

    All ``limit`` rows are kept unless ``max_recs`` asks for the best few after decay.
    """
    top = popularity(dwell, as_of, days, site, limit)
    decayed = time_decay(top, as_of, half_life, date_col="publish_date", value_col="score")
    scaled = normalise_by_max(decayed, "score")
    if max_recs is not None:
        scaled = scaled.orderBy(F.col("score").desc_nulls_last(), F.col("article_id")).limit(max_recs)
    return scaled.select(
        F.lit("default").alias("source_entity_id"),
        F.col("article_id").alias("recommended_article_id"),
        vectors.score_decimal(F.col("score")).alias("score"),
    )
