"""Landed web and API responses, which take the place of live requests.

``kind`` is ``page`` (asked for by path), ``article`` (asked for by external id) or
``bulk`` (a listing of many articles).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom import schemas
from pressroom.sources import files


def write_responses(rows: DataFrame, path: str) -> None:
    """Add landed responses, in folders by site, kind and the day they were fetched on."""
    days = rows.withColumn("fetched_on", F.to_date("fetched_at"))
    keys = ["site", "kind", "fetched_on"]
    days.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).parquet(path)


def read_responses(
    spark: SparkSession, path: str, site: str | None = None, fmt: str = "parquet", kinds: list[str] | None = None, since=None
) -> DataFrame:
    """Landed responses. Where they lie in folders by site, kind and day, only the folders of ``site`` and ``kinds``, fetched
    on the day ``since`` or later, are read."""
    by_day = bool([n for n in files.children(spark, path) if n.startswith("site=")])
    schema = schemas.RESPONSES + (", fetched_on date" if by_day else "")
    rows = spark.read.format(fmt).schema(schema).load(path)
    if site is not None:
        rows = rows.filter(F.col("site") == site)
    if kinds is not None:
        rows = rows.filter(F.col("kind").isin(kinds))
    if since is not None:
        rows = rows.filter(F.col("fetched_on" if by_day else "fetched_at") >= F.lit(since))
    return rows.drop("fetched_on")
