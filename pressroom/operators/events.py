"""Raw event lines -> normalised, pre-aggregated events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions import clock, computed_once


def _all_present(columns) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def judge_lines(lines: DataFrame, fields=config.REQUIRED_EVENT_FIELDS, text: str = "value") -> DataFrame:
    """Parse each JSON line once and add one column per field plus ``reason``, which is
    NULL for a usable line. A null value is usable, an absent key is not."""
    schema = ", ".join(f"{name} string" for name in (*fields, "_bad"))
    options = {"columnNameOfCorruptRecord": "_bad"}
    parsed = computed_once(lines, _json=F.from_json(F.col(text), schema, options))
    parsed = parsed.select("*", "_json.*").drop("_json")
    keys = F.json_object_keys(F.col(text))
    absent = F.array_size(F.array_except(F.array(*[F.lit(f) for f in fields]), keys))
    # the key list is only built for lines where some field came out null
    reason = (
        F.when(F.col("_bad").isNotNull() | F.col(text).isNull(), F.lit("malformed_json"))
        .when(_all_present(fields), F.lit(None).cast("string"))
        .when(keys.isNull(), F.lit("malformed_json"))
        .when(absent > 0, F.lit("missing_field"))
    )
    return parsed.withColumn("reason", reason).drop("_bad")


def parse_events(lines: DataFrame, fields=config.REQUIRED_EVENT_FIELDS, text: str = "value") -> DataFrame:
    judged = judge_lines(lines, fields, text)
    return judged.filter(F.col("reason").isNull()).drop("reason", text)


def quarantine_events(lines: DataFrame, fields=config.REQUIRED_EVENT_FIELDS, text: str = "value") -> DataFrame:
    judged = judge_lines(lines, fields, text)
    return judged.filter(F.col("reason").isNotNull()).drop(*fields)


def normalise_events(raw: DataFrame) -> DataFrame:
    """Rename, round to the second, and derive the session date and the hour chunk."""
    ts = F.col("collector_tstamp")
    if dict(raw.dtypes)["collector_tstamp"] == "string":
        ts = ts.try_cast("timestamp")
    else:
        ts = ts.cast("timestamp")
    timed = raw.withColumn("activity_time", clock.round_second(ts))
    return timed.select(
        F.col("domain_userid").alias("client_id"),
        "activity_time",
        F.to_date("activity_time").alias("session_date"),
        F.col("page_urlpath").alias("landing_page_path"),
        "event_name",
        "site",
        clock.chunk_name(F.col("activity_time")).alias("chunk_name"),
    )


GROUP = ["site", "client_id", "landing_page_path", "session_date", "chunk_name"]
COLUMNS = [
    "client_id",
    "activity_time",
    "session_date",
    "landing_page_path",
    "event_name",
    "ping_count",
    "site",
    "chunk_name",
]


def aggregate_pings(events: DataFrame) -> DataFrame:
    """One row per reader, path, date and chunk for pings; everything else unchanged.

    The group stays inside its chunk, so a chunk can be recomputed on its own. Only pings are
    shuffled; the input is read for each kind, so what is dear to compute should be settled.
    """
    is_ping = F.coalesce(F.col("event_name") == config.PAGE_PING, F.lit(False))
    complete = _all_present(["client_id", "landing_page_path", "session_date"])
    pings = (
        events.filter(is_ping & complete)
        .groupBy(*GROUP, "event_name")
        .agg(F.count(F.lit(1)).alias("ping_count"), F.min("activity_time").alias("activity_time"))
    )
    others = events.filter(~is_ping).withColumn("ping_count", F.lit(None).cast("long"))
    return pings.select(*COLUMNS).unionByName(others.select(*COLUMNS))


def hourly_pings(events: DataFrame) -> DataFrame:
    """Pings per site and tumbling event-time hour (works on a stream too)."""
    return (
        events.filter(F.col("event_name") == config.PAGE_PING)
        .groupBy("site", F.window("activity_time", "1 hour").alias("hour"))
        .agg(F.count(F.lit(1)).alias("pings"))
        .select("site", clock.chunk_name(F.col("hour.start")).alias("chunk_name"), "pings")
    )


def distinct_paths(events: DataFrame) -> DataFrame:
    return events.select("site", "landing_page_path").distinct()
