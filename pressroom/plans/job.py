"""The scheduled run of one site, and backfills."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom import config, schemas
from pressroom.operators import articles as art
from pressroom.operators import extraction, paths, registry
from pressroom.operators.metrics import RunMetrics
from pressroom.plans import ingest, metadata, recommend
from pressroom.plans.ledger import Ledger
from pressroom.session import configure, settle, temporary_tables
from pressroom.sources import chunks, commits, tables
from pressroom.sources.responses import read_responses


#: What a run does, in this order.
STAGES = ("events", "metadata", "dwell", "popularity", "article")


@dataclass(frozen=True)
class Store:
    """Where the tables of one deployment live."""

    raw: str
    base: str
    responses: str

    def table(self, name: str) -> str:
        return f"{self.base}/{name}"


def _update_events(spark, store: Store, site: config.SiteConfig, names: list[str], metrics: RunMetrics) -> None:
    ingest.ingest_events(
        spark, store.raw, store.table("events"), site, names, store.table("rejected"), metrics, manifest_path=store.table("event_hours")
    )


def _update_metadata(spark, store: Store, site, names: list[str], as_of: datetime, metrics: RunMetrics) -> metadata.MetadataUpdate:
    """Articles and path cache of one site in one commit. When another writer of the
    site was faster, everything is computed again from what it has written."""
    group = commits.metadata_group(store.base)
    reserve = lambda count: tables.reserve_ids(spark, store.table("article"), count)

    def attempt() -> metadata.MetadataUpdate:
        seen = commits.newest(spark, group, site.name)
        articles, cache = (commits.read(spark, group, site.name, t, seen) for t in ("article", "path"))
        replaced: dict[str, list[int]] = {}

        def part(name: str, keys: DataFrame) -> DataFrame:
            replaced[name] = commits.touched(group, name, seen, keys)
            return commits.read(spark, group, site.name, name, seen, replaced[name])

        events = tables.read_events(spark, store.table("events"))
        responses = read_responses(spark, store.responses, site.name)
        wanted = paths.paths_to_update(events, cache, articles, as_of, names, site.name)
        update = metadata.update_metadata(site, wanted, articles, cache, responses, as_of, reserve, part)
        changes = {"article": (replaced["article"], update.articles), "path": (replaced["path"], update.paths)}
        if any(buckets for buckets, _ in changes.values()):
            commits.write(spark, group, site.name, seen, changes)
        return update

    update = tables.retried(attempt)
    created, refreshed, errors = update.created.count(), update.refreshed.count(), update.errors
    known = tables.read_snapshot(spark, store.table("path"), schemas.PATHS, site.name)
    # an error that left a row in the path cache is settled; the others will be tried again
    open_errors = errors.join(known.select("site", "path"), ["site", "path"], "left_anti").count()
    metrics.add("article_scraping_total", created + refreshed + errors.count())
    metrics.add("article_scraping_creates", created)
    metrics.add("article_scraping_updates", refreshed)
    metrics.add("article_scraping_errors", open_errors)
    metrics.add("article_scraping_paths_written", known.filter(F.col("updated_at") == F.lit(as_of).cast("timestamp")).count())
    return update


def _update_dwell(spark, store: Store, site, dates: list[date]) -> None:
    articles = tables.read_snapshot(spark, store.table("article"), schemas.ARTICLES, site.name)
    ingest.refresh_dwell(
        spark, store.table("events"), store.table("dwelltimes"), articles, site.name, dates
    )


def new_model(spark: SparkSession, store: Store, model_type: str, site: str, as_of) -> int:
    """Register a pending model."""
    path = tables.of_site(store.table("model"), site)
    model_id = tables.reserve_ids(spark, store.table("model"), 1, block=1)
    tables.update_snapshot(spark, path, schemas.MODELS, lambda now: registry.register_model(now, model_id, model_type, site, as_of))
    return model_id


def publish(
    spark: SparkSession, store: Store, recs: DataFrame, model_type: str, site: str, as_of, metrics: RunMetrics, model_id: int | None = None
) -> int:
    """Write recommendations under a new model, or one that is registered already, make it current, drop models that went."""
    path = tables.of_site(store.table("model"), site)
    if model_id is None:
        model_id = new_model(spark, store, model_type, site, as_of)
    started = time.monotonic()
    tables.append_recs(metrics.counted(recs, f"rec_creation_total_{model_type}"), model_id, store.table("recommendation"))
    metrics.add(f"rec_creation_time_{model_type}", time.monotonic() - started, "Seconds")
    tables.update_snapshot(spark, path, schemas.MODELS, lambda now: registry.promote_model(now, model_id, model_type, site, as_of))
    # folders are listed before the registry is read: a model that another site registers meanwhile keeps its rows
    stored = tables.stored_models(spark, store.table("recommendation"))
    registered = tables.read_snapshot(spark, store.table("model"), schemas.MODELS)
    tables.drop_dead_recs(spark, store.table("recommendation"), registered, stored)
    return model_id


def refresh(spark, store: Store, site: config.SiteConfig, names: list[str], dates: list[date], as_of, metrics, ledger: Ledger, stages=STAGES) -> None:
    """Events, then article metadata, then dwell times, as far as they aren't done."""

    def timed(name: str, work: Callable[[], dict | None]) -> Callable[[], dict | None]:
        def measured() -> dict | None:
            started = time.monotonic()
            facts = work()
            metrics.add(name, time.monotonic() - started, "Seconds")
            return facts

        return measured

    if "events" in stages:
        ledger.once("events", timed("download_time", lambda: _update_events(spark, store, site, names, metrics)))
    if "metadata" in stages:

        def update() -> dict:
            _update_metadata(spark, store, site, names, as_of, metrics)
            return {"commit": commits.newest(spark, commits.metadata_group(store.base), site.name).number}

        ledger.once("metadata", timed("article_scraping_time", update))
    if "dwell" in stages:
        ledger.once("dwell", lambda: _update_dwell(spark, store, site, dates))


def run(
    spark: SparkSession,
    store: Store,
    site: config.SiteConfig,
    as_of: datetime,
    days: int = config.TRAINING_DAYS,
    max_recs: int = config.MAX_RECS,
    stages: tuple[str, ...] = STAGES,
) -> None:
    """One scheduled run, of all stages or those named. A failure is recorded as a metric and raised again; called again for the
    same time, the run goes on with the stages that hadn't finished.
    """
    configure(spark)
    metrics = RunMetrics(as_of.strftime("%Y%m%dT%H%M%S"), site=site.name)
    started, status = time.monotonic(), "success"
    try:
        with temporary_tables(spark):
            names = chunks.chunk_names(as_of, site.hours_of_data)
            dates = sorted({(as_of - timedelta(hours=i)).date() for i in range(site.hours_of_data)})
            ledger = Ledger(spark, store.base, site.name, as_of.strftime("%Y%m%dT%H%M%S"))
            refresh(spark, store, site, names, dates, as_of, metrics, ledger, stages)

            dwell = tables.read_dwell(spark, store.table("dwelltimes"))
            articles = tables.read_snapshot(spark, store.table("article"), schemas.ARTICLES, site.name)

            def published(model_type: str, recs: Callable[[], DataFrame]) -> dict:
                # the id is noted before anything is written under it, so another attempt leaves no second pending model
                model = ledger.once(f"{model_type}-model", lambda: {"model": new_model(spark, store, model_type, site.name, as_of)})["model"]
                publish(spark, store, recs(), model_type, site.name, as_of, metrics, model)
                return {"model": model}

            if "popularity" in stages:
                ledger.once("popularity", lambda: published("popularity", lambda: recommend.default_recs(dwell, site, as_of.date())))

            def trained() -> DataFrame:
                training = time.monotonic()
                recs = recommend.article_recs(dwell, articles, site, as_of.date(), days, max_recs)
                metrics.add("model_training_time", time.monotonic() - training, "Seconds")
                return recs

            if "article" in stages:
                ledger.once("article", lambda: published("article", trained))
            ledger.close()
    except Exception:
        status = "failure"
        raise
    finally:
        metrics.add("job_time", time.monotonic() - started, "Seconds", status=status)
        rows = metrics.rows() if status == "success" else metrics.added()
        spark.createDataFrame(rows, schemas.RUN_METRICS).write.mode("append").parquet(
            store.table("run_metrics")
        )


def backfill_events(
    spark: SparkSession, store: Store, site: config.SiteConfig, start: datetime, days: int
) -> None:
    """Rebuild events, metadata and dwell times for ``days`` days back from ``start``.

    Each day covers the 24 hour chunks that end at its midnight hour. Events are loaded some days at a time, the rest of
    the range is one job; a backfill that was broken off goes on with the stages that hadn't finished.
    """
    configure(spark)
    names = chunks.chunk_names(start, 24 * days)
    dates = sorted({(start - timedelta(hours=i)).date() for i in range(24 * days)})
    metrics = RunMetrics(start.strftime("backfill-%Y%m%d"), site=site.name)
    with temporary_tables(spark):
        ledger = Ledger(spark, store.base, site.name, start.strftime(f"backfill-%Y%m%dT%H%M%S-{days}"))
        refresh(spark, store, site, names, dates, start, metrics, ledger)
        ledger.close()
    metrics.frame(spark).write.mode("append").parquet(store.table("run_metrics"))


def backfill_articles(
    spark: SparkSession, store: Store, site: config.SiteConfig, start: date, days: int, as_of
) -> None:
    """Upsert the articles of a range of days from landed listings, as one set."""
    configure(spark)
    responses = read_responses(spark, store.responses, site.name)
    listed = extraction.bulk_articles(site, responses, start, start + timedelta(days=days))
    good = listed.filter(F.col("error_type").isNull())
    with temporary_tables(spark):
        good = settle(good)
        first_id = tables.reserve_ids(spark, store.table("article"), good.count())
        group = commits.metadata_group(store.base)

        def attempt() -> None:
            seen = commits.newest(spark, group, site.name)
            buckets = commits.touched(group, "article", seen, good)
            now = commits.read(spark, group, site.name, "article", seen, buckets)
            changes = {"article": (buckets, art.upsert_articles(now, good, as_of, first_id))}
            if not seen.number:  # the first commit takes over the paths that were there before
                changes["path"] = (buckets, commits.read(spark, group, site.name, "path", seen))
            if buckets:
                commits.write(spark, group, site.name, seen, changes)

        tables.retried(attempt)
