"""Session settings, and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from pressroom.sources import files

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without such a folder gets a scratch one: on a cluster a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="pressroom-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_open_scopes: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Remove the tables settled inside the block when it ends. What is computed from them
    has to be written by then."""
    written: list[str] = []
    _open_scopes.append(written)
    try:
        yield
    finally:
        _open_scopes.remove(written)
        for path in written:
            files.remove(spark, path)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    A lost executor can then not recompute it differently (sampled range bounds, partition
    ids) or repeat expensive work. Unlike an RDD checkpoint the rows are computed once, and
    readers prune columns and know the true size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/settled/{uuid.uuid4().hex}"
    for scope in _open_scopes[-1:]:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
