"""Parquet tables: partition replacement, appends, snapshots and exports."""

from __future__ import annotations

import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressroom import schemas
from pressroom.operators.metrics import observed
from pressroom.operators.skew import lookup_join
from pressroom.sources import files

EVENT_KEYS = ["site", "chunk_name"]
DWELL_KEYS = ["site", "session_date"]
REJECTED_KEYS = ["site", "chunk_dir"]


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned table, empty when nothing has been written yet."""
    if not files.children(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.EVENTS)


def read_dwell(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.DWELL_TIMES)


def read_recs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.RECOMMENDATIONS)


def replace_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``.

    The rebalance hint lets AQE split a partition with many rows over several tasks and
    merge tiny ones, so one hot site or hour does not become one task and one file.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def replace_chunks(events: DataFrame, path: str) -> None:
    """Idempotent load: rows of the batch's (site, chunk) pairs are replaced."""
    replace_partitions(events, path, EVENT_KEYS)


def replace_chunks_view(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """What the table holds after ``replace_chunks``, as a query."""
    touched = batch.select(*EVENT_KEYS).distinct()
    return lookup_join(stored, touched, EVENT_KEYS, "left_anti").unionByName(batch)


def replace_dwell(dwell: DataFrame, path: str, site: str, dates: list) -> None:
    """Replace the dwell times of one site on ``dates``; a date left without any rows
    loses the ones it had. The dates written are noted while the rows pass."""
    spark = dwell.sparkSession
    seen = Observation(f"dates of {site}")
    days = F.collect_set(F.when(F.col("site") == site, F.col("session_date").cast("string")))
    replace_partitions(dwell.observe(seen, days.alias("days")), path, DWELL_KEYS)
    present = set(files.children(spark, f"{path}/site={site}"))
    written = observed(seen).get("days") or []
    for day in map(str, dates):
        if day not in written and f"session_date={day}" in present:
            files.remove(spark, f"{path}/site={site}/session_date={day}")


def replace_rejected(bad: DataFrame | None, path: str, site: str, folders: list[str]) -> None:
    """Replace the rejected lines of the folders of a site; a folder without any loses the ones it had."""
    spark = SparkSession.getActiveSession() if bad is None else bad.sparkSession
    written = set()
    if bad is not None:
        written = {row["chunk_dir"] for row in bad.select("chunk_dir").distinct().collect()}  # folder names
        if written:
            replace_partitions(bad, path, REJECTED_KEYS)
    for name in files.children(spark, f"{path}/site={site}"):
        folder = unquote(name.removeprefix("chunk_dir="))
        if folder in folders and folder not in written:
            files.remove(spark, f"{path}/site={site}/{name}")


def append_recs(recs: DataFrame, model_id: int, path: str) -> None:
    """Store recommendations under their model. The model's folder is replaced as a whole,
    so a repeated attempt leaves no duplicates."""
    stamped = recs.withColumn("model_id", F.lit(model_id).cast("bigint"))
    replace_partitions(stamped, path, ["model_id"])


def stored_models(spark: SparkSession, path: str) -> list[int]:
    """Ids of the models that recommendations are stored under."""
    return [int(name.partition("=")[2]) for name in files.children(spark, path) if name.startswith("model_id=")]


def drop_dead_recs(spark: SparkSession, path: str, models: DataFrame, stored: list[int] | None = None) -> list[str]:
    """Delete the partitions of models that are no longer registered."""
    ids = stored_models(spark, path) if stored is None else stored
    if not ids:
        return []
    alive = {row["id"] for row in models.filter(F.col("id").isin(ids)).select("id").collect()}
    dead = [f"model_id={i}" for i in ids if i not in alive]
    for name in dead:
        files.remove(spark, f"{path}/{name}")
    return dead


def export_artifact(df: DataFrame, root: str, name: str) -> str:
    """CSV copy of a result with a header row."""
    target = f"{root}/{name}"
    df.write.mode("overwrite").option("header", True).csv(target)
    return target


class Conflict(Exception):
    """Somebody else has written the next version."""


def of_site(path: str, site: str) -> str:
    """Where the rows of one site are: each site has versions of its own, so sites don't wait for each other."""
    return f"{path}/site={site}"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Committed snapshot versions, oldest first; a version without its success marker
    was never finished and does not exist for readers."""
    numbers = [int(n[2:]) for n in files.children(spark, path) if n.startswith("v=") and n[2:].isdigit()]
    return sorted(n for n in numbers if files.exists(spark, f"{path}/v={n}/_SUCCESS"))


def latest_version(spark: SparkSession, path: str) -> int:
    """The newest version, 0 before the first."""
    return max(_versions(spark, path), default=0)


def read_version(spark: SparkSession, path: str, schema: str, number: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/v={number}") if number else spark.createDataFrame([], schema)


def read_snapshot(spark: SparkSession, path: str, schema: str, site: str | None = None) -> DataFrame:
    """The newest version of one site's rows, or of all sites' (a table without sites has one). A table that changes
    together with others has its versions in their common commits."""
    from pressroom.sources import commits

    if group := commits.group_of(spark, path):
        found = commits.read_newest(spark, path, schema, group, site)
        return reduce(DataFrame.unionByName, found, spark.createDataFrame([], schema))
    if site is not None:
        path = of_site(path, site)
    sites = [n for n in files.children(spark, path) if n.startswith("site=")]
    newest = [(p, latest_version(spark, p)) for p in ([f"{path}/{n}" for n in sites] or [path])]
    found = [f"{p}/v={n}" for p, n in newest if n]
    if not found:
        return spark.createDataFrame([], schema)
    # each folder by itself: the site is a column of the files
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p) for p in found])


def write_snapshot(df: DataFrame, path: str, keep: int = 3, after: int | None = None) -> int:
    """Write ``df`` as the version after ``after`` (the newest unless given). It may be computed from
    that one, which stays untouched; readers switch when the finished folder gets its name. Of two
    writers of the same version one gets a ``Conflict`` and leaves nothing behind."""
    spark = df.sparkSession
    number = (latest_version(spark, path) if after is None else after) + 1
    pending = f"_pending-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{pending}")
    # a folder that is moved to an existing one ends up inside it, where no reader looks
    if not files.exists(spark, f"{path}/v={number}"):
        files.move(spark, f"{path}/{pending}", f"{path}/v={number}")
    for lost in (f"{path}/{pending}", f"{path}/v={number}/{pending}"):
        if files.exists(spark, lost):
            files.remove(spark, lost)
            raise Conflict(f"{path}/v={number}")
    for old in _versions(spark, path)[:-keep]:
        files.remove(spark, f"{path}/v={old}")
    return number


def retried(change, attempts: int = 5):
    """The result of ``change``, which reads the newest versions and writes the next ones, tried again after a conflict."""
    for left in reversed(range(attempts)):
        try:
            return change()
        except Conflict:
            if not left:
                raise


def update_snapshot(spark: SparkSession, path: str, schema: str, change, attempts: int = 5) -> int:
    """Write ``change(newest version)`` as the next version; after a conflict the change is made to the newer one."""

    def attempt() -> int:
        number = latest_version(spark, path)
        return write_snapshot(change(read_version(spark, path, schema, number)), path, after=number)

    return retried(attempt, attempts)


def reserve_ids(spark: SparkSession, path: str, count: int, block: int = 1000) -> int:
    """The first of ``count`` consecutive ids that nobody else gets. Ids are handed out in blocks, each
    taken by creating a file that must not be there yet; gaps stay."""
    wanted = max(1, -(-count // block))
    taken = [int(n[6:]) for n in files.children(spark, f"{path}/_ids") if n.startswith("block=")]
    at, run = max(taken, default=-1) + 1, 0
    while run < wanted:
        run = run + 1 if files.create_new(spark, f"{path}/_ids/block={at + run:012d}") else 0
        if not run:
            at = 1 + max(int(n[6:]) for n in files.children(spark, f"{path}/_ids") if n.startswith("block="))
    return at * block + 1
