"""Small file-system helpers that go through Hadoop, so any shared store works."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when there is no such folder."""
    if not exists(spark, path):
        return []
    return [status.getPath().getName() for status in _fs(spark, path).listStatus(_path(spark, path))]


def all_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and bytes of the files under a folder at any depth; as for Spark's own sources, names that begin with ``_`` or ``.`` don't count."""
    found, under = _fs(spark, path).listFiles(_path(spark, path), True), _path(spark, path).depth()
    out = []
    while found.hasNext():
        status = found.next()
        name = status.getPath().toUri().toString()
        below = name.split("/")[under - status.getPath().depth() :]
        if not any(part.startswith(("_", ".")) for part in below):
            out.append((name, status.getLen()))
    return out


def size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of files under a folder."""
    summary = _fs(spark, path).getContentSummary(_path(spark, path))
    return summary.getLength(), summary.getFileCount()


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when somebody else has."""
    try:
        _fs(spark, path).create(_path(spark, path), False).close()
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):
            return False
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    out = _fs(spark, path).create(_path(spark, path), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    source = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, making the folders above the target."""
    above = _path(spark, target).getParent()
    _fs(spark, target).mkdirs(above)
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot move {source} to {target}")
