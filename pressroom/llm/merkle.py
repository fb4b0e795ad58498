"""A Merkle manifest of a dataset: a digest for every row, one for every group, one for the whole, and a proof for every row.

The tree of a group is rolled up in bounded blocks. A row's rank in its group is split into the block it falls in and the binary
digits within. Rows meet their block in one shuffle; then the digits are grouped away one after the other, the last first, and each
step nests the structs of the children in that of their parent, until a block is one row that holds its whole subtree. Blocks are nodes of the next
round, with ranks of their own, and so on until one node is left. Proofs come back down the same way: a block and the path above it meet as rows of one
aggregate, the nested structs are transformed into (row, path) pairs, and an explode emits them. All of it is built-in functions.

No step holds more than a block of one group in a task, whatever share of the rows the group has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.session import settle

#: Binary digits that are grouped away within a block; a block has up to two to that power rows.
DIGITS = 8
_ROW_BITS = 33  # monotonically_increasing_id keeps the row count in its low 33 bits
_STEP = "struct<side: string, digest: string>"


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its length in UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the fields of a row."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _ranked(rows: DataFrame, order: list) -> DataFrame:
    """Add ``rank``, from 0 within ``g``, and ``m``, the rows of ``g``. ``order`` sorts the rows of a group; ties are broken by row number, so
    a value that a third of all rows share is cut over many ranges too."""
    part, number = F.spark_partition_id(), F.monotonically_increasing_id()
    ranges = rows.withColumn("tie", number).repartitionByRange("g", *order, "tie").sortWithinPartitions("g", *order, "tie").drop("tie")
    ranged = settle(ranges.withColumn("part", part).withColumn("index", number - F.shiftleft(part.cast("long"), _ROW_BITS)))
    # one row for each group and range, so a group has as many as there are ranges at most
    sizes = ranged.groupBy("g", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("index").alias("first"))
    of_group = W.partitionBy("g")
    earlier = of_group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("g", "part", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(of_group).alias("m"))
    return ranged.join(sizes, ["g", "part"]).withColumn("rank", F.col("before") + F.col("index") - F.col("first")).drop("part", "index", "first", "before")


def _rolled_up(nodes: DataFrame) -> DataFrame:
    """``(g, m, rank, node)`` -> ``(g, m, block, tree)``. A level that is one node already in the whole group is not hashed again."""
    digits = [F.shiftright("rank", i).bitwiseAND(1) for i in range(DIGITS)]
    split = nodes.select("g", "m", F.shiftright("rank", DIGITS).alias("block"), *[d.alias(f"d{i}") for i, d in enumerate(digits)], "node")
    split = split.repartition("g", "block")  # serves all steps below: each groups by more than these two
    for level in range(DIGITS):
        keys = ["g", "m", "block", *[f"d{i}" for i in range(level + 1, DIGITS)]]
        pairs = F.array_sort(F.collect_list(F.struct(F.col(f"d{level}").alias("digit"), "node")), lambda a, b: (a.digit - b.digit).cast("int"))
        split = split.groupBy(*keys).agg(F.transform(pairs, lambda p: p.node).alias("children"))
        joined = F.array_join(F.transform("children", lambda c: c.digest), "")
        hashed = F.when(F.col("m") > 2**level, F.sha2(joined, 256)).otherwise(joined)
        split = split.select(*keys, F.struct(hashed.alias("digest"), "children").alias("node"))
    return split.withColumnRenamed("node", "tree")


def _step_down(m: Column, level: int):
    """Replace ``(node, path)`` by its children; each child's path begins with what its parent's digest needs besides it."""

    def children(x: Column) -> Column:
        several = F.size(x.node.children) > 1

        def child(c: Column, i: Column) -> Column:
            other = F.get(x.node.children, (1 - i).cast("int"))
            side = F.when(~several, F.lit("none")).when(i == 0, F.lit("right")).otherwise(F.lit("left"))
            sibling = F.struct(side.alias("side"), F.when(several, other.digest).otherwise(F.lit("")).alias("digest"))
            path = F.when(m > 2**level, F.concat(F.array(sibling), x.path)).otherwise(x.path)
            return F.struct(c.alias("node"), path.alias("path"))

        return F.transform(x.node.children, child)

    return children


def _paths(trees: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks and what lies above them -> one row for each node, ``(g, rank, node, up)``. ``above`` is ``(g, block, up)``; a block and its row there
    are brought together by an aggregate over both."""
    both = trees.unionByName(above, allowMissingColumns=True)
    met = both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("m", "tree", "up")])
    nodes = F.array(F.struct(F.col("tree").alias("node"), F.col("up.path").alias("path")))
    for level in reversed(range(DIGITS)):
        nodes = F.flatten(F.transform(nodes, _step_down(F.col("m"), level)))
    spread = met.select("g", "block", "up", F.posexplode(nodes).alias("i", "x"))
    up = F.struct("up.subroot", "up.root", F.col("x.path").alias("path"))
    return spread.select("g", (F.shiftleft("block", DIGITS) + F.col("i")).alias("rank"), F.col("x.node").alias("node"), up.alias("up"))


@dataclass
class _Climb:
    rounds: list[DataFrame]
    tops: DataFrame


def _climb(ranked: DataFrame) -> _Climb:
    """Roll up until every group is one node. Each round's blocks are settled; they are read once for the next round and once on the way down."""
    rounds, nodes, most = [], ranked, ranked.agg(F.max("m")).first()[0] or 0
    while True:
        trees = settle(_rolled_up(nodes))
        rounds.append(trees)
        most = -(-most >> DIGITS) if most > 1 << DIGITS else 1
        m = F.shiftright(F.col("m") + (2**DIGITS - 1), DIGITS)
        nodes = trees.select("g", m.alias("m"), F.col("block").alias("rank"), F.struct("tree.digest").alias("node"))
        if most <= 1:
            return _Climb(rounds, nodes.select("g", F.col("node.digest").alias("digest")))


def _descend(climb: _Climb, tops: DataFrame) -> DataFrame:
    """``(g, up)`` of the top nodes -> ``(node, up)`` of all leaves."""
    above = tops.select("g", F.lit(0).cast("long").alias("block"), "up")
    for trees in reversed(climb.rounds):
        found = _paths(trees, above)
        above = found.select("g", F.col("rank").alias("block"), "up")
    return found.select("node", "up")


def merkle_manifest(rows: DataFrame, group: Column, order: list[Column], leaf: Column, *carried: Column) -> DataFrame:
    """Per row: ``leaf``, ``subroot`` of its group, ``root``, ``path`` (from the leaf up to the root: the ``side`` and the ``digest`` of its sibling, side ``none``
    where it has none), and the ``carried`` columns.

    Leaves of a group follow ``order`` (null first), then their digest; rows that are equal in all of this are interchangeable, each has its own
    place. Two nodes are hashed together, the last of an odd number alone, until one is left; groups follow their name, bytewise, null
    first. An empty table gives no rows. Only ``carried`` columns of ``rows`` are kept, so no name can clash.
    """
    name = F.coalesce(F.concat(F.lit("x"), group.cast("string")), F.lit(""))
    sort = [f"o{i}" for i in range(len(order))]
    kept = F.struct(F.lit(0).alias("_"), *carried)
    leaves = rows.select(name.alias("g"), *[o.alias(n) for o, n in zip(order, sort, strict=True)], F.struct(leaf.alias("digest"), kept.alias("kept")).alias("node"))
    groups = _climb(_ranked(leaves, [*sort, F.col("node.digest")]).drop(*sort))
    tops = settle(groups.tops)
    whole = _climb(_ranked(tops.select(F.lit("").alias("g"), F.struct("digest", F.col("g").alias("of")).alias("node")), [F.col("node.of")]))
    nothing = F.array().cast(f"array<{_STEP}>")
    up = F.struct(F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), nothing.alias("path"))
    subroots = _descend(whole, whole.tops.select("g", up.alias("up")))
    up = F.struct(F.col("node.digest").alias("subroot"), "up.root", "up.path")
    leaves = _descend(groups, subroots.select(F.col("node.of").alias("g"), up.alias("up")))
    return leaves.select(F.col("node.digest").alias("leaf"), "up.subroot", "up.root", "up.path", "node.kept.*").drop("_")


def proof(path: Column) -> Column:
    """One digest of all siblings of a path, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s.digest), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    pair = lambda h, s: F.when(s.side == "left", F.concat(s.digest, h)).otherwise(F.concat(h, s.digest))
    return F.aggregate(path, leaf, lambda h, s: F.sha2(pair(h, s), 256))
