"""Tables that change together, and by parts: one commit names the files of all of them, bucket by bucket.

Rows are dealt to buckets by their key. A change reads and writes only the buckets its keys fall in; the commit that makes it
visible names new folders for those and the old ones for the rest. It is a small file in a folder that gets its name when it is complete, so readers
see all tables before a change or all of them after it, and of two writers one starts again from the other's result.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom import schemas
from pressroom.sources import files, tables
from pressroom.sources.tables import Conflict, of_site

#: Buckets of a table of a site. Noted in its first commit, so another number only holds for new tables.
BUCKETS = 64
POINTER = "_group"


@dataclass(frozen=True)
class Table:
    name: str
    schema: str
    key: tuple[str, ...]


@dataclass(frozen=True)
class Group:
    """Tables with common commits, for each site by itself."""

    base: str
    name: str
    tables: tuple[Table, ...]

    def table(self, name: str) -> Table:
        return next(t for t in self.tables if t.name == name)

    def path(self, site: str) -> str:
        return of_site(f"{self.base}/{self.name}", site)


@dataclass(frozen=True)
class Commit:
    """``number`` 0 is the state before the first commit. ``files`` has the folder of each bucket that has rows."""

    number: int
    buckets: int
    files: dict[str, dict[int, str]] = field(default_factory=dict)


def metadata_group(base: str) -> Group:
    """Articles and the path cache."""
    return Group(
        base,
        "metadata",
        (Table("article", schemas.ARTICLES, ("site", "external_id")), Table("path", schemas.PATHS, ("site", "path"))),
    )


def _load(spark: SparkSession, path: str, number: int) -> Commit:
    content = json.loads(files.read_text(spark, f"{path}/v={number}/commit.json"))
    named = {t: {int(b): folder for b, folder in of.items()} for t, of in content["files"].items()}
    return Commit(number, content["buckets"], named)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[2:]) for n in files.children(spark, path) if n.startswith("v=") and n[2:].isdigit())


def newest(spark: SparkSession, group: Group, site: str, buckets: int | None = None) -> Commit:
    numbers = _numbers(spark, group.path(site))
    return _load(spark, group.path(site), numbers[-1]) if numbers else Commit(0, buckets or BUCKETS)


def read(spark: SparkSession, group: Group, site: str, name: str, commit: Commit, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a table in a commit, of some buckets if named. Before the first commit, what the table held as plain snapshots."""
    table = group.table(name)
    if not commit.number:
        plain = of_site(f"{group.base}/{name}", site)
        rows = tables.read_version(spark, plain, table.schema, tables.latest_version(spark, plain))
        return rows if buckets is None else rows.filter(bucket_of(table, commit).isin(buckets))
    named = commit.files.get(name, {})
    folders = [folder for b, folder in sorted(named.items()) if buckets is None or b in buckets]
    if not folders:
        return spark.createDataFrame([], table.schema)
    # each folder is a data set by itself, so that its name adds no column
    return spark.read.schema(table.schema).option("recursiveFileLookup", True).parquet(*[f"{group.base}/{f}" for f in folders])


def bucket_of(table: Table, commit: Commit) -> Column:
    return F.pmod(F.xxhash64(*table.key), F.lit(commit.buckets)).cast("int")


def touched(group: Group, name: str, commit: Commit, keys: DataFrame) -> list[int]:
    """The buckets that keys fall in; all of them in the first commit, which takes over what was there before."""
    if not commit.number:
        return list(range(commit.buckets))
    # at most one small number for each bucket
    found = keys.select(bucket_of(group.table(name), commit).alias("bucket")).distinct().collect()
    return sorted(r["bucket"] for r in found)


def write(
    spark: SparkSession, group: Group, site: str, after: Commit, changes: dict[str, tuple[list[int], DataFrame]], keep: int = 3
) -> Commit:
    """Make ``changes`` visible as the commit after ``after``: by table, the buckets that are replaced and all their new rows."""
    named, written = {t.name: dict(after.files.get(t.name, {})) for t in group.tables}, []
    for name, (buckets, rows) in changes.items():
        folder = f"{name}/site={site}/data-{uuid.uuid4().hex}"
        parts = rows.withColumn("_bucket", bucket_of(group.table(name), after)).hint("rebalance", "_bucket")
        parts.write.partitionBy("_bucket").parquet(f"{group.base}/{folder}")
        written.append(f"{group.base}/{folder}")
        there = {int(n.partition("=")[2]) for n in files.children(spark, f"{group.base}/{folder}") if n.startswith("_bucket=")}
        if not there <= set(buckets):
            raise ValueError(f"rows of {name} outside the buckets that are replaced: {sorted(there - set(buckets))}")
        named[name] = {b: f for b, f in named[name].items() if b not in buckets} | {b: f"{folder}/_bucket={b}" for b in there}
    commit = Commit(after.number + 1, after.buckets, named)
    try:
        _publish(spark, group, site, commit)
    except Conflict:
        for path in written:
            files.remove(spark, path)
        raise
    for table in group.tables:
        files.create_new(spark, f"{group.base}/{table.name}/{POINTER}-{group.name}")
    _forget(spark, group, site, keep)
    return commit


def _publish(spark: SparkSession, group: Group, site: str, commit: Commit) -> None:
    path, pending = group.path(site), f"_pending-{uuid.uuid4().hex}"
    files.write_text(spark, f"{path}/{pending}/commit.json", json.dumps({"buckets": commit.buckets, "files": commit.files}))
    # a folder that is moved to an existing one ends up inside it, where no reader looks
    if not files.exists(spark, f"{path}/v={commit.number}"):
        files.move(spark, f"{path}/{pending}", f"{path}/v={commit.number}")
    for lost in (f"{path}/{pending}", f"{path}/v={commit.number}/{pending}"):
        if files.exists(spark, lost):
            files.remove(spark, lost)
            raise Conflict(f"{path}/v={commit.number}")


def _forget(spark: SparkSession, group: Group, site: str, keep: int) -> None:
    """Drop all but the newest commits, and the folders that only dropped ones name."""
    path = group.path(site)
    numbers = _numbers(spark, path)
    old, kept = ([_load(spark, path, n) for n in some] for some in (numbers[:-keep], numbers[-keep:]))
    used = {f.rpartition("/")[0] for c in kept for of in c.files.values() for f in of.values()}
    gone = {f.rpartition("/")[0] for c in old for of in c.files.values() for f in of.values()} - used
    for folder in gone:
        files.remove(spark, f"{group.base}/{folder}")
    for c in old:
        files.remove(spark, f"{path}/v={c.number}")


def group_of(spark: SparkSession, path: str) -> str | None:
    """The name of the group a table belongs to."""
    marks = [n for n in files.children(spark, path) if n.startswith(f"{POINTER}-")]
    return marks[0].removeprefix(f"{POINTER}-") if marks else None


def read_newest(spark: SparkSession, path: str, schema: str, group_name: str, site: str | None = None) -> list[DataFrame]:
    """The newest rows of a table of a group, by site."""
    base, _, name = path.rstrip("/").rpartition("/")
    group = Group(base, group_name, (Table(name, schema, ()),))
    sites = [n.removeprefix("site=") for n in files.children(spark, path) if n.startswith("site=")] if site is None else [site]
    return [read(spark, group, s, name, newest(spark, group, s)) for s in sites]
