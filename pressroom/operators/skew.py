"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task takes, and tasks that rows with a null key are spread over.
ROWS_PER_TASK = 1_000_000
NULL_SALTS = 256


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, the one it compares with the broadcast threshold.
    Filters and aggregates count as large as their input, which is the safe side here."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; -1 when broadcasts are switched off."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def key_counts(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows per key, combined map-side."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))


def lookup_join(
    big: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", counts: DataFrame | None = None
) -> DataFrame:
    """Join a fact side to a lookup side on ``on``.

    A lookup whose planned size is under the broadcast threshold goes the way Catalyst
    picks (a broadcast, so no shuffle and no skew). Anything larger is joined with its
    hot keys salted, whatever the threshold. Both ways give the same rows. Catalyst knows no size of a frame made
    from local data, so such a lookup counts as large unless it is settled. See ``salted_join`` for ``counts``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join kind {how!r}")
    if planned_bytes(lookup) <= broadcast_limit(lookup):
        return big.join(lookup, on, how)
    return salted_join(big, lookup, on, how, counts)


def salted_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Spread every key of ``big`` that has more than ``rows_per_task`` rows over as many tasks as that asks for.

    ``counts`` (the keys and ``_rows``) says how frequent keys are, where that is known
    already or cheaper to learn from another table than from ``big``; it steers the spread
    and cannot change the result. There are at most (rows of ``big`` / ``rows_per_task``) such keys;
    only lookup rows with those keys are copied. Rows of ``big`` with a null key match nothing and are spread like a
    hot key.
    """
    columns = big.columns
    some_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    hot = F.broadcast(
        (key_counts(big, on) if counts is None else counts)
        .filter(~some_null & (F.col("_rows") > rows_per_task))
        .groupBy(*on)
        .agg(F.ceil(F.max("_rows") / rows_per_task).cast("int").alias("_salts"))
    )
    # equal rows are spread by the partition they are in; both are the same when a lost task runs again
    salts = F.when(some_null, F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    drawn = F.pmod(F.xxhash64(*columns, F.spark_partition_id()), salts).cast("int")
    left = big.join(hot, on, "left").withColumn("_salt", F.when(salts > 1, drawn).otherwise(F.lit(0)))
    every_salt = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = lookup.join(hot, on, "left").withColumn("_salt", F.explode(every_salt)).drop("_salts")
    joined = left.drop("_salts").join(right, [*on, "_salt"], how).drop("_salt")
    rest = [c for c in joined.columns if c not in columns]
    return joined.select(*columns, *rest)
