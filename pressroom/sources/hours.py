"""The hour manifest: which hours the lines of a loaded folder belong to.

A line may land hours after it happened, so an hour that is loaded again may need many folders. The manifest keeps, for every folder
that was loaded, how many usable lines it has of each hour, and how large it was then. Folders only ever grow: while a folder has the size that is
noted, it is read again only for hours that it has lines of.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

from pressroom import schemas
from pressroom.sources import files, tables

KEYS = ["site", "chunk_dir"]


@dataclass(frozen=True)
class Folder:
    """Size of a folder when it was loaded, and its usable lines by hour."""

    size: tuple[int, int]
    lines: dict[str, int] = field(default_factory=dict)


def sizes(spark: SparkSession, root: str, site: str, folders: list[str]) -> dict[str, tuple[int, int]]:
    """Bytes and files of each folder."""
    return {f: files.size(spark, f"{root}/{site}/{f}") for f in folders}


def known(spark: SparkSession, path: str | None, site: str, folders: list[str]) -> dict[str, Folder]:
    """What is noted of the named folders. Only their own partitions are read: some rows for each, of which there are as many as hours
    that its lines may be late."""
    if path is None:
        return {}
    there = {unquote(n.removeprefix("chunk_dir=")) for n in files.children(spark, f"{path}/site={site}")}
    mine = [f"{path}/site={site}/chunk_dir={quote(f, safe='')}" for f in folders if f in there]
    if not mine:
        return {}
    rows = spark.read.schema(schemas.EVENT_HOURS).option("basePath", path).parquet(*mine).collect()
    found: dict[str, Folder] = {}
    for r in rows:
        folder = found.setdefault(r["chunk_dir"], Folder((r["bytes"], r["files"])))
        if r["chunk_name"] is not None:
            folder.lines[r["chunk_name"]] = r["lines"]
    return found


def note(spark: SparkSession, path: str, site: str, folders: dict[str, Folder]) -> None:
    """Replace what is noted of these folders. A folder without usable lines has one row without an hour."""
    rows = [(site, name, hour, lines, *f.size) for name, f in folders.items() for hour, lines in (f.lines or {None: 0}).items()]
    if rows:
        tables.replace_partitions(spark.createDataFrame(rows, schemas.EVENT_HOURS), path, KEYS)


def needed(noted: dict[str, Folder], present: dict[str, tuple[int, int]], hours: set[str]) -> list[str]:
    """Folders that may hold lines of ``hours``: those that are known to, and those that are new or have grown."""
    return sorted(f for f, size in present.items() if f not in noted or noted[f].size != size or hours & noted[f].lines.keys())


def changed_hours(noted: dict[str, Folder], now: dict[str, dict[str, int]]) -> set[str]:
    """Hours of which a folder has another number of lines than when it was loaded."""
    nothing = Folder((0, 0))
    out = set()
    for name, lines in now.items():
        before = noted.get(name, nothing).lines
        out |= {hour for hour in before.keys() | lines.keys() if before.get(hour) != lines.get(hour)}
    return out
