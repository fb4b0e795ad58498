"""Blocks of vectors with a bound on what any vector of a block can score, so that whole blocks are left out of an exact search.

Vectors are dealt to the nearest of some pivots; within a pivot's cell they are sorted by falling weight and cut into blocks. A block is summed up by its centre c, its
radius r, the lengths of its shortest and longest vector and its least and largest weight. For a query x every vector y of the block then has
x.y between x.c - |x| r and x.c + |x| r (triangle inequality), and between -|x||y| and |x||y| (Cauchy-Schwarz). Queries work
the bounds out where they meet the rows: nothing is broadcast, and the driver learns only how many rows a cell has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.operators.ordering import numbered
from pressroom.operators.tiles import BLOCK_ROWS, tile_apply
from pressroom.session import settle

#: Blocks a cell has on average: so many levels of weight are told apart within it.
BLOCKS_PER_CELL = 16
#: At most so many pivots are kept by every task.
MOST_CELLS = 256


def matrix(vectors: pd.Series, unit: bool = False) -> np.ndarray:
    """Vectors as rows; ``unit`` scales them to length one and leaves zero vectors as they are."""
    rows = np.vstack(vectors.to_numpy()).astype(np.float64)
    if unit:
        length = np.linalg.norm(rows, axis=1, keepdims=True)
        rows = np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)
    return rows


@dataclass(frozen=True)
class BlockIndex:
    """``rows`` have their ``_block`` and the first block of their cell, ``_home``; ``summary`` has one row for each block."""

    rows: DataFrame
    summary: DataFrame
    n_blocks: int


def _summarised(vector: str, weight: str, unit: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def work(block: pd.DataFrame) -> pd.DataFrame:
        rows = matrix(block[vector], unit)
        centre = rows.mean(axis=0)
        return pd.DataFrame(
            {
                "_block": [block["_block"].iloc[0]],
                "centre": [centre],
                "radius": [np.linalg.norm(rows - centre, axis=1).max()],
                "shortest": [np.linalg.norm(rows, axis=1).min()],
                "longest": [np.linalg.norm(rows, axis=1).max()],
                "bottom": [block[weight].min()],
                "top": [block[weight].max()],
                "n_rows": [len(block)],
            }
        )

    return work


def block_index(df: DataFrame, key: str, vector: str, weight: str, n_rows: int, block_rows: int = BLOCK_ROWS, cells: int | None = None, unit: bool = False) -> BlockIndex:
    """Cut ``df`` into blocks of at most ``block_rows``. ``unit`` measures directions instead of vectors. Without ``cells`` their number
    follows the number of blocks."""
    if cells is None:
        cells = -(-n_rows // block_rows) // BLOCKS_PER_CELL
    cells = max(1, min(cells, MOST_CELLS))
    cell, start, first = F.lit(0), F.lit(0).cast("long"), F.lit(0)
    if cells > 1:
        # at most MOST_CELLS vectors, the same in every run
        drawn = df.select(key, vector).orderBy(F.xxhash64(key), key).limit(cells).toPandas()
        pivots = matrix(drawn[vector], unit)
        half = (pivots * pivots).sum(axis=1) / 2

        @F.pandas_udf("int")
        def nearest_pivot(vectors: pd.Series) -> pd.Series:
            return pd.Series(np.argmax(matrix(vectors, unit) @ pivots.T - half, axis=1))

        df = settle(df.withColumn("_cell", nearest_pivot(vector)))
        sizes = dict(df.groupBy("_cell").count().collect())
        rows, blocks, starts = 0, 0, []
        for c in sorted(sizes):
            starts.append((c, rows, blocks))
            rows, blocks = rows + sizes[c], blocks - (-sizes[c] // block_rows)
        cell = F.col("_cell")
        start = F.element_at(F.create_map(*[F.lit(x) for c, r, _ in starts for x in (c, r)]), cell).cast("long")
        first = F.element_at(F.create_map(*[F.lit(x) for c, _, b in starts for x in (c, b)]), cell)
    ordered = numbered(df, [*([F.col("_cell")] if cells > 1 else []), F.col(weight).desc(), F.col(key)], "_position")
    block = first + F.floor((F.col("_position") - start) / F.lit(block_rows))
    rows = ordered.withColumn("_block", block.cast("int")).withColumn("_home", first.cast("int")).drop("_position", "_cell")
    schema = "_block int, centre array<double>, radius double, shortest double, longest double, bottom double, top double, n_rows long"
    summary = settle(rows.groupBy("_block").applyInPandas(_summarised(vector, weight, unit), schema))
    return BlockIndex(rows, summary, summary.count())


def every_block(index: BlockIndex, groups: int) -> DataFrame:
    """Each of ``groups`` groups of queries with each block, for ``tile_apply``."""
    return index.summary.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_lb"), F.col("_block").alias("_rb"))


def blocks_of_groups(groups: DataFrame, index: BlockIndex, n_groups: int, work: Callable[[pa.Table, Iterator[pa.Table]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``(_lb, _rb)``: the blocks that each group of ``groups`` wants, as ``work(queries, summaries)`` tells."""
    piece = F.floor(F.col("_block") / F.lit(BLOCK_ROWS)).cast("int")
    pieces = range(-(-index.n_blocks // BLOCK_ROWS))
    each = index.rows.sparkSession.range(n_groups).select(F.col("id").cast("int").alias("_lb"), F.explode(F.array(*[F.lit(p) for p in pieces])).alias("_rb"))
    return tile_apply(each, groups, index.summary.withColumn("_rb", piece), work, "_lb int, _rb int")


def summarised(block: np.ndarray, rows: np.ndarray) -> pd.DataFrame:
    """Centre, radius, greatest length and number of the rows of each stretch of rows that have one ``block``: a piece of a block has bounds of its own."""
    first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    n = np.diff(np.append(first, len(block)))
    centre = np.add.reduceat(rows, first, axis=0) / n[:, None]
    far = np.linalg.norm(rows - np.repeat(centre, n, axis=0), axis=1)
    return pd.DataFrame({"_block": block[first], "centre": list(centre), "radius": np.maximum.reduceat(far, first), "longest": np.maximum.reduceat(np.linalg.norm(rows, axis=1), first), "n_rows": n})


def dot_bounds(queries: np.ndarray, summaries: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each query with any vector of each block."""
    length = np.linalg.norm(queries, axis=1, keepdims=True)
    middle, far = queries @ matrix(summaries["centre"]).T, length * summaries["radius"].to_numpy()
    reach = length * summaries["longest"].to_numpy()
    return np.maximum(middle - far, -reach), np.minimum(middle + far, reach)
