"""Mixing sources to target weights by Poisson replication.

A source whose documents should be seen ``rate`` times on average has each of them seen a Poisson number of times with that mean. The
number is found by inversion of the distribution at a uniform value that a hash of the seed and the document gives, so it is the same in every run and
on every machine. The copies are then put in the order of another hash, which shuffles them over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.session import free_name
from pressroom.session import settle

#: Each source gets a share of the mix in proportion to its size to this power: 1 keeps the mix, 0 makes all sources equal.
TEMPER = 0.5
SEED = 17
#: A mean above this is drawn as the sum of several draws with an equal part of it.
MOST_MEAN = 32.0
#: No Poisson number with a mean of MOST_MEAN or less exceeds this at the 52 bits that are drawn.
MOST_DRAWN = 120


def hashed(*parts: Column) -> Column:
    """The first 13 hexadecimal digits of an md5, as a number below 2 ** 52."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def poisson(mean: Column, uniform: Column) -> Column:
    """The Poisson number whose cumulative probability first exceeds a uniform value."""
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_DRAWN)),
        F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.lit(0).alias("k")),
        lambda a, k: F.struct(
            (a.p * mean / k).alias("p"),
            (a["sum"] + a.p * mean / k).alias("sum"),
            (a.k + F.when(a["sum"] <= uniform, 1).otherwise(0)).alias("k"),
        ),
    )
    return walked.k


def rates(docs: DataFrame, targets: DataFrame | None = None, size: Column | None = None, temper: float = TEMPER) -> DataFrame:
    """``(source, rate)``: how often each source's documents are repeated on average.

    ``targets (source, weight)`` names the share of the mix that each source should get, by size (characters unless given); a source that is
    not named or has no positive weight gets none. Without targets the weights are the sizes to the power ``temper``. The mix has the size of the
    input. A source of size 0 has rate 0.
    """
    size = F.coalesce(F.char_length("text"), F.lit(0)) if size is None else size
    sizes = docs.groupBy("source").agg(F.sum(size).cast("double").alias("size"))
    if targets is None:
        weighed = sizes.withColumn("weight", F.pow("size", F.lit(temper)))
    else:
        named = targets.groupBy(F.col("source").alias("named")).agg(F.sum("weight").cast("double").alias("weight"))
        weighed = sizes.join(named, F.col("source").eqNullSafe(F.col("named")), "left")
        weighed = weighed.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    weighed = settle(weighed)
    total = weighed.agg(F.sum("size").alias("size"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("weight")).first()
    if not total["size"] or not total["weight"]:
        return weighed.select("source", F.lit(0.0).alias("rate"))
    rate = F.col("weight") * F.lit(total["size"]) / (F.lit(total["weight"]) * F.col("size"))
    return weighed.select("source", F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate"))


def copies(rate: Column, key: Column, seed: int) -> Column:
    """How often a document is taken."""
    parts = F.greatest(F.ceil(rate / MOST_MEAN), F.lit(1))
    uniform = lambda i: hashed(F.lit(str(seed)), key, i.cast("string")) / float(1 << 52)
    drawn = F.transform(F.sequence(F.lit(1).cast("long"), parts.cast("long")), lambda i: poisson(rate / parts, uniform(i)))
    return F.aggregate(drawn, F.lit(0), lambda a, x: a + x)


def mix(docs: DataFrame, targets: DataFrame | None = None, key: str = "doc_id", seed: int = SEED, temper: float = TEMPER) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, with ``copy`` (from 1) and ``place``; dealt out by ``place`` over all
    partitions, and in its order within each.

    ``place`` is a hash of seed, key and copy. Rows with equal keys are drawn alike, as are null keys; a null
    source is a source of its own, and so is a null text of size 0, which only the rate of its source decides. Columns of ``docs`` named
    ``copy`` or ``place`` are replaced. An empty table gives no rows.
    """
    docs = docs.drop("copy", "place")
    source, rate, number = (free_name(docs, n) for n in ("_source", "_rate", "_copies"))
    by_source = settle(rates(docs, targets, temper=temper)).select(F.col("source").alias(source), F.col("rate").alias(rate))
    keyed = F.coalesce(F.col(key).cast("string"), F.lit(""))
    drawn = docs.join(by_source, F.col("source").eqNullSafe(F.col(source))).withColumn(number, copies(F.col(rate), keyed, seed))
    taken = drawn.filter(F.col(number) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(number))))
    placed = taken.withColumn("place", hashed(F.lit(f"{seed}|place"), keyed, F.col("copy").cast("string")))
    return placed.drop(source, rate, number).repartition("place").sortWithinPartitions("place", key, "copy")
