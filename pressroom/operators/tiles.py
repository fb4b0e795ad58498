"""Lead blocks of rows past groups of other rows, so that each task multiplies bounded matrices.

A group of left rows is held by one task; the right blocks that are meant for it follow as a stream, through a sort by group and block.
So a left row is shuffled once, a right row once for each group, and what leaves a task is a reduced result, never the pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.session import settle

BLOCK_ROWS = 2048
COPIES_PER_TASK = 64
#: Groups that left rows are dealt to, however many there are, as long as a group has no more rows than one task can hold.
SWEEPS, LEAST_SWEPT, MOST_SWEPT = 36, 256, 1 << 16
#: Lists that the rows of a group come in. A block comes as one.
LEFT_PACKS = 32


def blocks(df: DataFrame, position: str, block_rows: int, name: str) -> DataFrame:
    """Blocks in the order of ``position``, of exactly ``block_rows`` rows (the last may be shorter)."""
    return df.withColumn(name, F.floor(F.col(position) / F.lit(block_rows)).cast("int"))


def sweeps(rows: int) -> int:
    """How many groups ``rows`` left rows are dealt to. Every group is passed by all right rows, so the number stays the same
    until the rows of a group would be too many."""
    return max(1, min(SWEEPS, -(-rows // LEAST_SWEPT)), -(-rows // MOST_SWEPT))


def vector_rows(lists: pa.Array) -> np.ndarray:
    """Equally long lists as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(lists), -1)


def tile_apply(
    wanted: DataFrame,
    left: DataFrame,
    right: DataFrame,
    work: Callable[[pa.Table, Iterator[pa.Table]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``wanted (_lb, _rb)`` says which right blocks each group of ``left`` meets; ``left`` has ``_lb`` on each row, ``right`` has ``_rb``.
    ``work`` gets all rows of a group, and the rows of its blocks one piece after another, in the order of ``_rb``, at most a few thousand to a block."""
    wanted = settle(_own_columns(wanted.select("_lb", "_rb").distinct()))
    copies = _served(_packed(right, "_rb", "block"), wanted)
    left, copies = _packed(left, "_lb", "rows", LEFT_PACKS), _own_columns(copies)
    none = lambda df, column: F.lit(None).cast(df.schema[column].dataType).alias(column)
    both = left.select("_lb", F.lit(None).cast("int").alias("_rb"), "rows", none(copies, "block")).unionByName(copies.select("_lb", "_rb", none(left, "rows"), "block"))
    tasks = min(SWEEPS, (wanted.agg(F.max("_lb")).first()[0] or 0) + 1)
    dealt = both.repartitionById(tasks, F.pmod("_lb", F.lit(tasks)))
    return dealt.sortWithinPartitions("_lb", F.asc_nulls_first("_rb")).mapInArrow(_swept(work), schema)


def _packed(df: DataFrame, key: str, name: str, packs: int = 1) -> DataFrame:
    """The rows of each key as lists, since what a row costs on its way to Python is far more than what its numbers cost."""
    rows = F.struct(*[c for c in df.columns if c != key])
    pack = F.pmod(F.xxhash64(*df.columns), F.lit(packs)) if packs > 1 else F.lit(0)
    return _own_columns(df.groupBy(key, pack.alias("_pack")).agg(F.collect_list(rows).alias(name)).drop("_pack"))


def _swept(work):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.Table]]:
        """Stretches of rows of one group and one side."""
        for batch in batches:
            if not batch.num_rows:
                continue
            group, is_left = batch.column("_lb").to_numpy(), batch.column("_rb").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((group[1:] != group[:-1]) | (is_left[1:] != is_left[:-1])) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(group)]):
                lists = batch.column("rows" if is_left[a] else "block").slice(a, b - a)
                side = lists.flatten()
                found = pa.Table.from_arrays(side.flatten(), [f.name for f in side.type])
                if not is_left[a]:
                    block = batch.column("_rb").slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int32)
                    found = found.append_column("_rb", pa.array(np.repeat(block, lists.value_lengths().to_numpy())))
                yield int(group[a]), bool(is_left[a]), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in itertools.groupby(pieces(batches), key=lambda x: x[0]):
            rows = []
            for _, is_left, piece in found:
                if not is_left:
                    found = itertools.chain([(_, is_left, piece)], found)
                    break
                rows.append(piece)
            if rows:
                yield from work(pa.concat_tables(rows).combine_chunks(), (piece for _, _, piece in found))

    return run


def _served(right: DataFrame, wanted: DataFrame) -> DataFrame:
    """Copies of each right block for all that want it. A block wanted by very many, such as
    the first one of a neighbour search, is handed out by several tasks, each of which
    serves about ``COPIES_PER_TASK`` left blocks."""
    tasks = wanted.groupBy("_rb").agg(F.ceil(F.count(F.lit(1)) / COPIES_PER_TASK).cast("int").alias("_tasks"))
    served = _own_columns(right.join(tasks, "_rb"))
    served = served.withColumn("_task", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)))
    served = served.drop("_tasks").repartition("_rb", "_task")
    asking = wanted.join(tasks, "_rb").withColumn("_task", F.pmod(F.xxhash64("_lb"), F.col("_tasks")).cast("int"))
    return served.join(_own_columns(asking.drop("_tasks")), ["_rb", "_task"]).drop("_task")


def _own_columns(df: DataFrame) -> DataFrame:
    """New column identities, since both sides may stem from one table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])
