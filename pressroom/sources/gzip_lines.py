"""Lines of gzip files whatever their names are: a data source that unpacks each file as a stream.

Spark's text source goes by the suffix of a name, and its binary source holds a file as one value, so neither reads large
files that lost their suffix. Here a file is never in memory, neither packed nor unpacked.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pressroom.sources import files

#: Packed bytes a task reads, and what one file counts at least; a larger file is a task of its own.
TASK_BYTES, FILE_BYTES = 32 << 20, 1 << 20
#: Lines and characters handed on together, whichever is reached first.
BATCH_LINES, BATCH_CHARS = 10_000, 4 << 20


def packed(found: list[tuple[str, int]]) -> list[list[str]]:
    """Files for each task, in the order of their names, by size."""
    out: list[list[str]] = []
    room = 0
    for name, size in sorted(found):
        if room < max(size, FILE_BYTES):
            out.append([])
            room = TASK_BYTES
        out[-1].append(name)
        room -= max(size, FILE_BYTES)
    return out


def opened(name: str) -> pa.NativeFile:
    """A file as a stream; names are as Hadoop writes them."""
    scheme = urlsplit(name).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_stream(unquote(urlsplit(name).path) if scheme else name)
    system, path = fs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))
    return system.open_input_stream(path)


def _batches(name: str) -> Iterator[pa.RecordBatch]:
    def batch(values: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [name] * len(values), "value": values})

    with opened(name) as raw, gzip.open(raw, "rt", encoding="utf-8", errors="replace") as lines:
        some: list[str] = []
        chars = 0
        for line in lines:
            some.append(line.rstrip("\n"))
            chars += len(line)
            if len(some) >= BATCH_LINES or chars >= BATCH_CHARS:
                yield batch(some)
                some, chars = [], 0
        if some:
            yield batch(some)


class GzipLines(DataSource):
    """``spark.read.format("gzip_lines")`` with option ``tasks``, a JSON list of file names for each task; ``read`` below fills it in."""

    @classmethod
    def name(cls) -> str:
        return "gzip_lines"

    def schema(self) -> str:
        return "path string, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["tasks"]))


class _Reader(DataSourceReader):
    def __init__(self, tasks: list[list[str]]):
        self.tasks = tasks

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(names) for names in self.tasks]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for name in partition.value:
            yield from _batches(name)


def read(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``(path, value)``: the lines of all files under the folders, several gzip members in a row included. A file that is cut off fails the read."""
    found = [file for folder in folders for file in files.all_files(spark, folder)]
    if not found:
        return spark.createDataFrame([], "path string, value string")
    spark.dataSource.register(GzipLines)
    return spark.read.format("gzip_lines").option("tasks", json.dumps(packed(found))).load()
