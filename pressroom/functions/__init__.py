"""Column expressions; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add expensive columns that are evaluated once per row.

    Behind a plain projection Catalyst copies the expression into every filter it pushes
    down; it does not push filters through a generator.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
