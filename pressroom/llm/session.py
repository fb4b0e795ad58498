"""Settings of sessions that run these operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressroom.session import configure

#: Rows that go to Python at once. Texts are long, and a batch is held by Spark and by Python at the same time.
BATCH_ROWS = 4000
#: The same for a job that has many stages in one session, and also the rows that are read from a file at once.
SMALL_BATCH_ROWS = 500


def ready(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """The settings every operator of the library relies on, and batches that suit long texts."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    if rows < BATCH_ROWS:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", rows)
    return spark


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
