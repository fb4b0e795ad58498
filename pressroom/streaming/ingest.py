"""Incremental ingestion: files as they land -> chunks of the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressroom import config
from pressroom.operators import events
from pressroom.operators.metrics import RunMetrics
from pressroom.plans.ingest import Source, in_steps, load_folders
from pressroom.sources import chunks


def landed_lines(spark: SparkSession, root: str, site: str, max_files: int | None = None) -> DataFrame:
    """Stream of ``(value, site, chunk_dir)`` from files landing under the site's chunks."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(f"{root}/{site}").select(
        "value",
        F.lit(site).alias("site"),
        F.regexp_extract(F.col("_metadata.file_path"), chunks.CHUNK_IN_PATH, 1).alias("chunk_dir"),
    )


def stream_ingest(
    spark: SparkSession,
    root: str,
    events_path: str,
    checkpoint: str,
    site: config.SiteConfig,
    oldest_chunk: str | None = None,
    max_files: int | None = None,
    rejected_path: str | None = None,
    metrics: RunMetrics | None = None,
    manifest_path: str | None = None,
) -> StreamingQuery:
    """Process what has landed since the last call and stop.

    A batch only tells which folders have news. Those are parsed once; hours of which they have more lines than
    the hour manifest notes are computed again from all folders that have lines of them and replaced, so a late line re-opens its chunk and a
    repeated batch changes nothing. The manifest is kept beside the stream's own progress unless it has another place. Hours before ``oldest_chunk`` are ignored. Unusable
    lines of the folders go to ``rejected_path``, as in the batch load.
    """
    source = Source(root, events_path, rejected_path, manifest_path or f"{checkpoint}/event_hours")
    # the end of the folder before may be rounded into the oldest chunk
    first = min(chunks.folders_around([oldest_chunk], 0)) if oldest_chunk else None

    def load(batch: DataFrame, _batch_id: int) -> None:
        folders = sorted(row["chunk_dir"] for row in batch.select("chunk_dir").distinct().collect())  # one name per hour
        folders = [n for n in folders if n and (first is None or n >= first)]
        step = lambda some, done: load_folders(batch.sparkSession, source, site, some, oldest_chunk=oldest_chunk, done=done)
        in_steps(step, folders, metrics)

    lines = landed_lines(spark, root, site.name, max_files)
    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_pings_stream(normalised: DataFrame, hours_of_data: int) -> DataFrame:
    """Pings per site and hour; an hour is final once ``hours_of_data`` have passed."""
    return events.hourly_pings(normalised.withWatermark("activity_time", f"{hours_of_data} hours"))
