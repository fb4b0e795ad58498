"""Reader x article interactions for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions import clock
from pressroom.operators.ordering import dense_codes
from pressroom.operators.skew import key_counts, lookup_join


def article_activity(dwell: DataFrame) -> DataFrame:
    return dwell.groupBy("article_id").agg(F.count(F.lit(1)).alias("rows_per_article"))


def user_activity(dwell: DataFrame) -> DataFrame:
    return dwell.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("rows_per_user"), F.sum("duration").alias("seconds_per_user")
    )


def recent_dwell(dwell: DataFrame, as_of, days: int, site: str | None = None) -> DataFrame:
    rows = dwell.filter(clock.last_n_days(F.col("session_date"), as_of, days))
    return rows if site is None else rows.filter(F.col("site") == site)


def training_interactions(
    dwell: DataFrame,
    articles: DataFrame,
    as_of,
    max_article_age: int,
    days: int = config.TRAINING_DAYS,
    site: str | None = None,
    min_article_rows: int = config.MIN_ROWS_PER_ARTICLE,
    min_user_rows: int = config.MIN_ROWS_PER_READER,
    min_user_seconds: int = config.MIN_READER_SECONDS,
    min_duration: int = config.MIN_DURATION,
    max_duration: int = config.MAX_DURATION,
) -> DataFrame:
    """Dwell rows of active readers on well-read, recent articles.

    Activity is counted over all rows of the window, before the duration filter. The two
    small sides are reduced to the keys that pass, so the dwell rows see two joins.
    """
    window = recent_dwell(dwell, as_of, days, site)
    oldest = F.date_sub(clock.as_date(as_of), max_article_age * 365)
    per_article, per_user = article_activity(window), user_activity(window)
    busy_articles = per_article.filter(F.col("rows_per_article") > min_article_rows)
    dated = articles.filter(F.col("published_at") > oldest).select(
        F.col("id").alias("article_id"), F.col("published_at").cast("date").alias("published_at")
    )
    wanted_articles = dated.join(busy_articles.select("article_id"), "article_id")
    wanted_users = per_user.filter(
        (F.col("rows_per_user") > min_user_rows) & (F.col("seconds_per_user") > min_user_seconds)
    ).select("client_id")
    rows = window.filter(F.col("duration").between(min_duration, max_duration)).select(
        "article_id", "external_id", "client_id", "session_date", "duration"
    )
    # the activity counts also say which keys are hot
    article_rows = per_article.withColumnRenamed("rows_per_article", "_rows")
    user_rows = per_user.withColumnRenamed("rows_per_user", "_rows")
    kept = lookup_join(rows, wanted_articles, ["article_id"], counts=article_rows)
    kept = lookup_join(kept, wanted_users, ["client_id"], "left_semi", counts=user_rows)
    return kept.select("article_id", "external_id", "client_id", "session_date", "duration", "published_at")


def prepare_interactions(interactions: DataFrame, parts: int | None = None) -> DataFrame:
    """Drop incomplete rows and add dense integer codes.

    ``item_id``/``user_id`` are 0-based codes of the sorted ids, ``timestamp`` is a 1-based
    code of the sorted session dates. The input is a settled table or a cheap plan: it is
    read once for each code list.
    """
    complete = interactions.na.drop("any")
    coded = complete
    for column, code in (("external_id", "item_id"), ("client_id", "user_id"), ("session_date", "_day")):
        codes = dense_codes(complete, column, code, parts)
        coded = lookup_join(coded, codes, [column], counts=key_counts(complete, [column]))
    return (
        coded.withColumn("item_id", F.col("item_id").cast("int"))
        .withColumn("user_id", F.col("user_id").cast("int"))
        .withColumn("timestamp", (F.col("_day") + 1).cast("int"))
        .drop("_day")
    )


def most_read_article(interactions: DataFrame) -> DataFrame:
    counts = interactions.groupBy("external_id").agg(F.count(F.lit(1)).alias("reads"))
    return counts.orderBy(F.col("reads").desc(), F.col("external_id")).limit(1)


def item_dimension(prepared: DataFrame, as_of, half_life: float) -> DataFrame:
    """One row per external id - the latest publish date, then the smallest article id -
    with its decay."""
    best = F.max(F.struct("published_at", (-F.col("article_id")).alias("_minus_id"))).alias("_best")
    chosen = prepared.groupBy("external_id", "item_id").agg(best)
    return chosen.select(
        "external_id",
        "item_id",
        (-F.col("_best._minus_id")).alias("article_id"),
        F.col("_best.published_at").alias("published_at"),
    ).withColumn("decay", clock.half_life_decay(as_of, F.col("published_at"), half_life))
