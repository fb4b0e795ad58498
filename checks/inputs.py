"""The driver's tables read as this engine's domain tables (Spark side).

``duck.py`` states the same mappings in SQL. Every mapping covers its whole tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.operators import dwell, events
from pressroom.session import configure, settle

EVENT_DAY = date(2024, 1, 30)  # last day of `events`
ORDER_DAY = date(2001, 11, 4)  # last ship date


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def text(value) -> F.Column:
    return value.cast("string")


def article_path(number):
    return F.concat(F.lit("/article/"), text(number + 100), F.lit("/slug-"), text(number))


def site_of(number):
    return F.concat(F.lit("site-"), text(number % 3))


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Views are pings, clicks are page views; each reader keeps to a hundred articles."""
    rows = read(spark, sf, "events")
    n = F.get_json_object("props", "$.k").cast("bigint") + F.col("user_id") % 10 * 100
    name = (
        F.when(F.col("event_type") == "view", "page_ping")
        .when(F.col("event_type") == "click", "page_view")
        .otherwise(F.col("event_type"))
    )
    return rows.withColumn("n", n).select(
        text(F.col("user_id")).alias("domain_userid"),
        F.col("ts").cast("timestamp").alias("collector_tstamp"),
        article_path(F.col("n")).alias("page_urlpath"),
        name.alias("event_name"),
        site_of(F.col("n")).alias("site"),
        "n",
    )


def raw_events_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Three readers and ten articles, so that pings really group."""
    return dense_view(read(spark, sf, "events"))


def dense_view(rows: DataFrame) -> DataFrame:
    n = F.get_json_object("props", "$.k").cast("bigint") % 10
    name = F.when(F.col("event_type") == "signup", "page_view").otherwise("page_ping")
    return rows.withColumn("n", n).select(
        text(F.col("user_id") % 3).alias("domain_userid"),
        F.col("ts").cast("timestamp").alias("collector_tstamp"),
        article_path(F.col("n")).alias("page_urlpath"),
        name.alias("event_name"),
        site_of(F.col("n")).alias("site"),
        "n",
    )


def event_lines(spark: SparkSession, sf: str, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """JSON lines of the raw events. By article number: 0 lacks a key, 1 is cut off, 2 has a
    null reader. ``keep`` names columns of the raw events that stay."""
    raw = raw_events(spark, sf)
    digit = F.col("n") % 10
    stamp = F.date_format("collector_tstamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("collector_tstamp")
    reader = F.when(digit != 2, F.col("domain_userid")).alias("domain_userid")
    keep_nulls = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct(stamp, reader, "event_name", "page_urlpath"), keep_nulls)
    short = F.to_json(F.struct(stamp, reader, "event_name"), keep_nulls)
    cut = F.left(whole, F.length(whole) - 5)
    value = F.when(digit == 0, short).when(digit == 1, cut).otherwise(whole)
    return raw.select(value.alias("value"), "site", *keep)


def normalised(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    return events.normalise_events((raw_events_dense if dense else raw_events)(spark, sf))


def stored_events(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    return events.aggregate_pings(normalised(spark, sf, dense))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Every document is an article; every 17th has no date."""
    n = F.col("doc_id")
    day = F.date_add(F.lit(date(2023, 11, 1)), (n % 90).cast("int")).cast("timestamp")
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return read(spark, sf, "documents").select(
        (n + 1).alias("id"),
        site_of(n).alias("site"),
        text(n + 100).alias("external_id"),
        F.concat("source", F.lit(" "), "lang", F.lit(" "), text(F.col("n_chars"))).alias("title"),
        article_path(n).alias("path"),
        F.when(n % 17 != 0, day).alias("published_at"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "labels").select((F.col("doc_id") + 1).alias("id"), "quality", "toxic")


def stored_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles already in the table: the documents that have a label."""
    return articles(spark, sf).join(labelled(spark, sf).select("id"), "id", "left_semi")


def paths(spark: SparkSession, sf: str) -> DataFrame:
    """Path cache, as a stored table: labelled documents, of which the toxic ones are excluded."""
    known = articles(spark, sf).join(labelled(spark, sf), "id")
    toxic = F.col("toxic") == 1
    cache = known.select(
        "site",
        "path",
        F.when(~toxic, F.col("external_id")).alias("external_id"),
        F.when(toxic, F.lit("no_external_id")).alias("exclude_reason"),
        "created_at",
        "updated_at",
    )
    return settle(cache)


def event_dwell(spark: SparkSession, sf: str, dense: bool = False) -> DataFrame:
    return dwell.dwell_times(stored_events(spark, sf, dense), articles(spark, sf))


def order_dwell(spark: SparkSession, sf: str) -> DataFrame:
    """Customers read parts: ship date = session, quantity x 10 = seconds."""
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    part = F.col("article_id")
    grouped = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(
            F.col("o_custkey").alias("client_id"),
            F.col("l_partkey").alias("article_id"),
            F.col("l_shipdate").cast("date").alias("session_date"),
        )
        .agg(F.sum(F.col("l_quantity") * 10).cast("bigint").alias("duration"))
    )
    return grouped.select(
        "duration",
        text(F.col("client_id")).alias("client_id"),
        part,
        F.concat(F.lit("p"), text(part)).alias("external_id"),
        F.date_add(F.lit(date(1999, 1, 1)), (part * 7919 % 1000).cast("int")).alias("published_at"),
        F.lit("site-0").alias("site"),
        "session_date",
    )


def order_articles(dwell_rows: DataFrame) -> DataFrame:
    return dwell_rows.select(F.col("article_id").alias("id"), "external_id", "site", "published_at").distinct()


def stored_order_dwell(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a stored table, for plans that read it several times."""
    return settle(order_dwell(spark, sf))


def item_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.date_add(F.lit(date(2023, 11, 1)), (F.col("vec_id") % 90).cast("int")).alias("published_at"),
    )


def models(spark: SparkSession, sf: str) -> DataFrame:
    """Every order is a model: status by order status, type and site by priority and customer."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "stale")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("current")
    )
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "popularity").otherwise("article")
    stamp = F.col("o_orderdate").cast("timestamp")
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        kind.alias("type"),
        status.alias("status"),
        F.concat(F.lit("site-"), text(F.col("o_custkey") % 20)).alias("site"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def newest_pending(registry: DataFrame) -> DataFrame:
    pending = registry.filter(F.col("status") == "pending")
    return pending.groupBy("type", "site").agg(F.max("id").alias("id"))


def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(
        F.lit("default").alias("source_entity_id"),
        F.col("l_partkey").alias("recommended_article_id"),
        F.col("l_discount").cast("decimal(7,6)").alias("score"),
        F.col("l_orderkey").alias("model_id"),
    )


def plain(df: DataFrame) -> DataFrame:
    """Days, moments and decimals as text and doubles, so that engines compare alike."""
    shown = {
        "date": lambda c: c.cast("string"),
        "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
        "double": lambda c: F.round(c, 6),
    }
    out = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind in shown:
            column = shown[kind](column)
        elif kind.startswith("decimal"):
            column = F.round(column.cast("double"), 6)
        elif kind == "int":
            column = column.cast("bigint")
        out.append(column.alias(name))
    return df.select(*out)
