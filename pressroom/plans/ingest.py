"""Raw chunks -> events table, and events -> dwell times."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions import clock
from pressroom.operators import dwell, events
from pressroom.operators.metrics import RunMetrics, observed
from pressroom.session import settle
from pressroom.sources import chunks, tables
from pressroom.sources import hours as manifest

#: Hours that are loaded in one go, when years of folders are.
HOURS_AT_ONCE = 240


def judge(lines: DataFrame, fields=config.REQUIRED_EVENT_FIELDS) -> DataFrame:
    """Parsed lines with the reason why a line cannot be used, as in ``events.judge_lines``;
    an unreadable time is one more."""
    judged = events.judge_lines(lines, fields)
    if "collector_tstamp" not in fields:
        return judged
    no_time = F.col("collector_tstamp").try_cast("timestamp").isNull()
    bad_time = F.when(no_time, F.lit("bad_timestamp"))
    return judged.withColumn("reason", F.coalesce(F.col("reason"), bad_time))


def events_from_judged(judged: DataFrame, normalise=None) -> DataFrame:
    usable = judged.filter(F.col("reason").isNull())
    return events.aggregate_pings((normalise or events.normalise_events)(usable))


def events_from_lines(lines: DataFrame, fields=config.REQUIRED_EVENT_FIELDS, normalise=None) -> DataFrame:
    """``(value, site)`` lines -> pre-aggregated events; unusable lines are left out. The parsed
    lines are settled, since pings and other events go separate ways."""
    return events_from_judged(settle(judge(lines, fields).drop("value")), normalise)


def judge_landed(lines: DataFrame, site: config.SiteConfig) -> DataFrame:
    """``judge`` for lines of chunk folders: a line that landed more than ``hours_of_data``
    after its hour, or before it, has a reason of its own. No load would find such a line again."""
    judged = judge(lines, site.event_fields)
    if "collector_tstamp" not in site.event_fields:
        return judged
    hour = F.date_trunc("hour", clock.round_second(F.col("collector_tstamp").try_cast("timestamp")))
    landed = F.try_to_timestamp("chunk_dir", F.lit("yyyy/MM/dd/HH"))
    hours = (F.unix_seconds(landed) - F.unix_seconds(hour)) / 3600
    outside = F.when((hours < -1) | (hours > site.hours_of_data), F.lit("outside_horizon"))
    return judged.withColumn("reason", F.coalesce(F.col("reason"), outside))


def hours_of_folders(judged: DataFrame, site: config.SiteConfig) -> dict[str, dict[str, int]]:
    """Usable lines of each folder by the hour they belong to: one short row for each pair, as many for a folder as its lines may be
    hours late. The folder travels as the site, which every event rule keeps."""
    usable = judged.filter(F.col("reason").isNull()).withColumn("site", F.col("chunk_dir"))
    pairs = (site.event_rule or events.normalise_events)(usable).groupBy("site", "chunk_name").count()
    found: dict[str, dict[str, int]] = {}
    for row in pairs.filter("chunk_name IS NOT NULL").collect():
        found.setdefault(row["site"], {})[row["chunk_name"]] = row["count"]
    return found


@dataclass(frozen=True)
class Source:
    """Where the raw lines of a site are, where what is made of them goes, and how they are packed. ``manifest`` is the place of
    the hour manifest; without it every folder that could hold lines of an hour is read for it."""

    root: str
    events: str
    rejected: str | None = None
    manifest: str | None = None
    gzip_without_suffix: bool = False


def _judged(spark: SparkSession, source: Source, site: config.SiteConfig, folders: list[str], seen: Observation | None = None) -> DataFrame | None:
    """The lines of folders, parsed once and settled, with the raw text of the unusable ones only."""
    if not folders:
        return None
    unusable = F.col("reason").isNotNull()
    lines = chunks.read_event_chunks(spark, source.root, site.name, folders, source.gzip_without_suffix)
    judged = judge_landed(lines, site).withColumn("value", F.when(unusable, F.col("value")))
    if seen is not None:
        judged = judged.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(unusable).alias("rejected"))
    return settle(judged)


def load_folders(
    spark: SparkSession,
    source: Source,
    site: config.SiteConfig,
    names: list[str],
    hours: list[str] | None = None,
    oldest_chunk: str | None = None,
    done: frozenset[str] = frozenset(),
) -> tuple[set[str], dict[str, int]]:
    """Load the lines of the named folders: every hour they belong to is computed again as a whole and replaced, but those in ``done``.

    ``hours`` are replaced besides. Without ``hours`` only those are loaded of which a folder has more lines than the manifest notes, and none
    before ``oldest_chunk``. Each folder is parsed once: the named ones first, which tells the hours; then other folders, as far as
    they have lines of these hours. The manifest is written last, so a load that was broken off is made again.
    Returns the hours that were loaded, and counts.
    """
    there = chunks.landed(spark, source.root, site.name, names)
    present = manifest.sizes(spark, source.root, site.name, there) if source.manifest else {}
    seen = Observation(f"lines of {site.name}")
    named = _judged(spark, source, site, there, seen)
    by_folder = {f: {} for f in there} | (hours_of_folders(named, site) if there else {})
    if hours is None:
        wanted = manifest.changed_hours(manifest.known(spark, source.manifest, site.name, there), by_folder)
        wanted = {h for h in wanted if oldest_chunk is None or h >= oldest_chunk} - done
    else:
        wanted = {*hours, *(h for lines in by_folder.values() for h in lines)} - done

    around = sorted({*chunks.folders_around(sorted(wanted), site.hours_of_data)} - {*there}) if wanted else []
    around = chunks.landed(spark, source.root, site.name, around)
    if source.manifest:
        noted = manifest.known(spark, source.manifest, site.name, around)
        around = manifest.needed(noted, manifest.sizes(spark, source.root, site.name, around), wanted)
    parts = [p for p in (named, _judged(spark, source, site, around)) if p is not None]
    written = Observation(f"events of {site.name}")
    if parts and wanted:
        rows = events_from_judged(reduce(DataFrame.unionByName, parts), site.event_rule).filter(F.col("chunk_name").isin(sorted(wanted)))
        tables.replace_chunks(rows.observe(written, F.count(F.lit(1)).alias("events")), source.events)
    if source.rejected is not None:
        bad = None if named is None else named.filter(F.col("reason").isNotNull()).drop(*site.event_fields)
        tables.replace_rejected(bad, source.rejected, site.name, names)
    if source.manifest:
        manifest.note(spark, source.manifest, site.name, {f: manifest.Folder(present[f], by_folder[f]) for f in there})
    counts = {"downloaded_rows": 0, "rejected_rows": 0, "written_events": 0, "read_folders": len(there) + len(around)}
    if there:
        counts |= {"downloaded_rows": observed(seen).get("lines", 0), "rejected_rows": observed(seen).get("rejected", 0)}
    if parts and wanted:
        counts["written_events"] = observed(written).get("events", 0)
    return wanted, counts


def in_steps(load: Callable[[list[str], frozenset[str]], tuple[set[str], dict[str, int]]], names: list[str], metrics: RunMetrics | None) -> None:
    """Load many folders ``HOURS_AT_ONCE`` at a time, the newest first. An hour that an earlier step has loaded is whole already."""
    ordered, done, total = sorted({*names}, reverse=True), frozenset(), {}
    for first in range(0, len(ordered), HOURS_AT_ONCE):
        hours, counts = load(ordered[first : first + HOURS_AT_ONCE], done)
        done |= hours
        total = {k: total.get(k, 0) + v for k, v in counts.items()}
    if metrics is not None:
        for name, value in total.items():
            metrics.add(name, value)


def ingest_events(
    spark: SparkSession,
    root: str,
    events_path: str,
    site: config.SiteConfig,
    names: list[str],
    rejected_path: str | None = None,
    metrics: RunMetrics | None = None,
    gzip_without_suffix: bool = False,
    manifest_path: str | None = None,
) -> None:
    """Load the named chunks of one site, replacing what the events table held for them.

    A line may land in a folder after its hour, or be rounded into the next one, so the hours
    that the named folders have lines of are loaded too, each from all folders that can hold it; with a manifest, that do hold it.
    """
    source = Source(root, events_path, rejected_path, manifest_path, gzip_without_suffix)
    in_steps(lambda some, done: load_folders(spark, source, site, some, some, done=done), names, metrics)


def refresh_dwell(
    spark: SparkSession,
    events_path: str,
    dwell_path: str,
    articles: DataFrame,
    site: str,
    dates: list,
    aliases: DataFrame | None = None,
) -> None:
    """Recompute the dwell times of one site for ``dates`` in one job."""
    stored = tables.read_events(spark, events_path)
    rows = dwell.dwell_times(stored, articles, site, dates, aliases)
    tables.replace_dwell(rows, dwell_path, site, dates)
