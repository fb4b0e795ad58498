"""Vector and score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def l2_normalise(vector: Column) -> Column:
    """Unit-length copy; a zero vector stays zero."""
    length = norm(vector)
    safe = F.when(length == 0.0, F.lit(1.0)).otherwise(length)
    return F.transform(vector, lambda x: x.cast("double") / safe)


def unit_similarity(cosine: Column) -> Column:
    """Cosine on [-1, 1] as a similarity on [0, 1]; undefined becomes 0."""
    value = (F.lit(1.0) + cosine) / F.lit(2.0)
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def cosine(left: Column, right: Column) -> Column:
    return F.try_divide(dot(left, right), norm(left) * norm(right))


def score_decimal(score: Column) -> Column:
    """The stored form of a score. A publish date in the future can lift a score above 1; it is clipped
    to the largest number that can be stored."""
    top = F.lit(9.999999)
    return F.when(score > top, top).otherwise(score).cast("decimal(7,6)")
