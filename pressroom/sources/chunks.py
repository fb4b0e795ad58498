"""Hourly click-stream chunks: ``<root>/<site>/YYYY/MM/DD/HH/*`` with gzip JSON lines."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.functions import clock
from pressroom.sources import files, gzip_lines

CHUNK_IN_PATH = r"/([0-9]{4}/[0-9]{2}/[0-9]{2}/[0-9]{2})/"


def chunk_window(spark: SparkSession, as_of, hours: int) -> DataFrame:
    """The ``hours`` hour chunks that end with the one ``as_of`` falls in. ``as_of`` may
    be a value or a scalar subquery."""
    back = F.make_dt_interval(F.lit(0), F.col("id").cast("int"))
    return spark.range(hours).select(clock.chunk_name(clock.as_timestamp(as_of) - back).alias("chunk_name"))


def chunk_names(as_of: datetime, hours: int) -> list[str]:
    """The same window as plain names, to prune folders and partitions with."""
    return [(as_of - timedelta(hours=i)).strftime("%Y/%m/%d/%H") for i in range(hours)]


def folders_around(names: list[str], late_hours: int) -> list[str]:
    """Folders that can hold lines of the named hours: rounding to the second moves a line
    into the next hour, and a line may land up to ``late_hours`` after it happened."""
    moments = [datetime.strptime(name, "%Y/%m/%d/%H") for name in names]
    around = {m + timedelta(hours=h) for m in moments for h in range(-1, late_hours + 1)}
    return sorted(m.strftime("%Y/%m/%d/%H") for m in around)


def landed(spark: SparkSession, root: str, site: str, chunks: list[str]) -> list[str]:
    """The named chunks that have a folder; each day's folder is listed once."""
    days = {day: set(files.children(spark, f"{root}/{site}/{day}")) for day in {chunk[:10] for chunk in chunks}}
    return [chunk for chunk in chunks if chunk[11:] in days[chunk[:10]]]


def chunk_paths(spark: SparkSession, root: str, site: str, chunks: list[str]) -> list[str]:
    """Folders of the named chunks that are there."""
    return [f"{root}/{site}/{chunk}" for chunk in landed(spark, root, site, chunks)]


def read_event_chunks(
    spark: SparkSession, root: str, site: str, chunks: list[str], gzip_without_suffix: bool = False
) -> DataFrame:
    """Lines of the named chunks as ``(value, site, chunk_dir)``, flat or nested folders.

    Files named ``*.gz`` are decoded by the text source. ``gzip_without_suffix`` is for
    landed files that lost their suffix.
    """
    paths = chunk_paths(spark, root, site, chunks)
    if not paths:
        return spark.createDataFrame([], "value string, site string, chunk_dir string")
    if gzip_without_suffix:
        lines = gzip_lines.read(spark, paths)
    else:
        lines = (
            spark.read.option("recursiveFileLookup", True)
            .text(paths)
            .select(F.col("_metadata.file_path").alias("path"), "value")
        )
    return lines.select(
        "value", F.lit(site).alias("site"), F.regexp_extract("path", CHUNK_IN_PATH, 1).alias("chunk_dir")
    )
