"""Positions and running totals over a whole table, without one task seeing it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.operators.skew import lookup_join
from pressroom.session import settle

_ROW_BITS = 33  # monotonically_increasing_id keeps the row count in its low 33 bits


def _ranged(df: DataFrame, order: list, parts: int | None) -> DataFrame:
    """Sort into ranges and note (range, index in range) on every row.

    Without ``parts`` AQE merges neighbouring ranges that turn out small. Range bounds are
    sampled, so the outcome is settled before anything reads it twice.
    """
    part = F.spark_partition_id()
    ranges = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return settle(
        ranges.sortWithinPartitions(*order)
        .withColumn("_part", part)
        .withColumn("_index", F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), _ROW_BITS))
    )


def numbered(df: DataFrame, order: list, name: str, parts: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the total order ``order`` (which has to
    tell any two rows apart)."""
    ranged = _ranged(df, order, parts)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range, so at most as many rows as shuffle partitions
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_index"))
        .drop("_part", "_index", "_offset")
    )


def dense_codes(df: DataFrame, column: str, code: str, parts: int | None = None) -> DataFrame:
    """One row per distinct non-null value of ``column`` with its 0-based sorted code."""
    keys = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return numbered(keys, [F.col(column)], code, parts)


def with_dense_code(df: DataFrame, column: str, code: str, parts: int | None = None) -> DataFrame:
    return lookup_join(df, dense_codes(df, column, code, parts), [column], "left")


def total_before(
    df: DataFrame, group: list[str], order: list, weight: Column, name: str, parts: int | None = None
) -> DataFrame:
    """Per row, the sum of ``weight`` over the rows of its group that sort ahead of it.

    ``group + order`` has to tell any two rows apart. Ranges cut through a large group, so
    its rows are summed by many tasks and then shifted by the totals of earlier ranges.
    """
    keys = [F.col(c) for c in group]
    ranged = _ranged(df.withColumn("_weight", weight), [*keys, *order], parts)
    ahead = W.partitionBy("_part", *group).orderBy("_index").rowsBetween(W.unboundedPreceding, -1)
    local = ranged.withColumn("_ahead", F.coalesce(F.sum("_weight").over(ahead), F.lit(0)))
    totals = ranged.groupBy("_part", *group).agg(F.sum("_weight").alias("_total"))
    # per group at most one row per range
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select(
        "_part", *group, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift")
    )
    return (
        local.join(shifts, ["_part", *group])
        .withColumn(name, F.col("_ahead") + F.col("_shift"))
        .drop("_part", "_index", "_weight", "_ahead", "_shift")
    )
