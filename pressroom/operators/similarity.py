"""Most similar recent articles per article, exactly, without forming all pairs.

score(i, j) = decay(j) * (1 + cos(i, j)) / 2, for j != i.

A score never exceeds the decay of its target, and hardly any target is as close as the closest. Targets are therefore cut into
blocks of similar direction and decay (``operators/index.py``); each source first meets the most recent block of its own
neighbourhood, and its k-th best score there says which other blocks can still matter: those in which a target could
reach it, by the block's largest decay and the angle between the source and the block. Such blocks then pass the groups of sources, and the
scores of a block are computed only for sources it matters to. The result is still the exact top k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions.vectors import score_decimal
from pressroom.operators.index import block_index, dot_bounds, blocks_of_groups, summarised
from pressroom.operators.skew import lookup_join
from pressroom.operators.tiles import BLOCK_ROWS, sweeps, tile_apply, vector_rows
from pressroom.session import settle

SCORE_DIGITS = 9  # scores are compared after rounding, so that ties do not hang on the last bits


def unit_rows(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, zero vectors as they are, and which have a direction."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0), length[:, 0] > 0


def in_reach(units: np.ndarray, floor: np.ndarray, summaries: pd.DataFrame, top: np.ndarray) -> np.ndarray:
    """Blocks (columns) in which some target could reach a source's floor, by the block's largest decay and the angle between the two."""
    high = np.clip(dot_bounds(units, summaries)[1], -1.0, 1.0)
    return top * (1.0 + high) / 2.0 + 2 * 10.0**-SCORE_DIGITS >= floor[:, None]


def sure_floor(units: np.ndarray, summaries: pd.DataFrame, k: int) -> np.ndarray:
    """What every target scores in the best blocks that together have more than ``k`` rows."""
    low = dot_bounds(units, summaries)[0]
    least = summaries["bottom"].to_numpy() * (1.0 + np.clip(low, -1.0, 1.0)) / 2.0
    # without a direction there is no cosine, and the score is 0
    least[np.linalg.norm(units, axis=1) == 0] = 0.0
    least[:, summaries["shortest"].to_numpy() == 0] = 0.0
    order = np.argsort(-least, axis=1)
    enough = np.cumsum(summaries["n_rows"].to_numpy()[order], axis=1) > k
    sure = np.take_along_axis(np.take_along_axis(least, order, axis=1), enough.argmax(axis=1)[:, None], axis=1)[:, 0]
    return np.where(enough[:, -1], sure - 2 * 10.0**-SCORE_DIGITS, 0.0)


def blocks_in_reach(sources: pa.Table, pieces: Iterator[pa.Table], k: int) -> Iterator[pa.RecordBatch]:
    """The blocks that matter to some source of a group, from their summaries."""
    units, floor, home = unit_rows(vector_rows(sources.column("embedding").combine_chunks()))[0], sources.column("_floor").to_numpy(), sources.column("_home").to_numpy()
    for piece in pieces:
        for start in range(0, len(piece), TILE_TARGETS):
            summaries = piece.slice(start, TILE_TARGETS).to_pandas()
            top, blocks, found = summaries["top"].to_numpy(), summaries["_block"].to_numpy(), np.zeros(len(summaries), bool)
            for at in range(0, len(units), TILE_SOURCES):
                some = slice(at, at + TILE_SOURCES)
                wanted = in_reach(units[some], np.maximum(floor[some], sure_floor(units[some], summaries, k)), summaries, top)
                found |= (wanted & (home[some][:, None] != blocks)).any(axis=0)
            group = np.full(int(found.sum()), sources.column("_group")[0].as_py(), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(blocks[found])], ["_lb", "_rb"])


#: Sources and targets that are multiplied at once, and candidates of a source that are kept before they are cut to the best.
TILE_SOURCES, TILE_TARGETS, KEPT = 512, 2048, 16


class Best:
    """The best ``k`` targets of each source, by (score desc, id asc), tile by tile. ``floor`` is a score that a source's targets need at least;
    it rises as better ones are found. ``multiplied`` is the number of scores computed so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None, home: np.ndarray | None = None):
        self.ids, self.k, self.home = ids, k, home
        self.units, usable = unit_rows(vectors)
        # an undefined cosine has to end up as score 0
        self.wide = np.concatenate([self.units, usable[:, None]], axis=1)
        self.floor = np.zeros(len(ids)) - np.inf if floor is None else floor.copy()
        self.row, self.found, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = self.multiplied = 0

    def meet(self, block: np.ndarray, ids: np.ndarray, vectors: np.ndarray, decay: np.ndarray) -> None:
        """Targets with their block; the rows of a block stand together."""
        units, usable = unit_rows(vectors)
        wide = np.concatenate([units, usable[:, None]], axis=1) * (decay / 2)[:, None]
        summaries = summarised(block, units)
        blocks, sizes = summaries["_block"].to_numpy(), summaries["n_rows"].to_numpy()
        top, which = np.fmax.reduceat(decay, np.cumsum(sizes) - sizes), np.repeat(np.arange(len(sizes)), sizes)
        for at in range(0, len(self.ids), TILE_SOURCES):
            some = slice(at, at + TILE_SOURCES)
            wanted = in_reach(self.units[some], self.floor[some], summaries, top)
            if self.home is not None:  # their targets are known already
                wanted &= self.home[some][:, None] != blocks
            rows, columns = at + np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0)[which])
            if len(rows):
                whole = len(columns) == len(ids)
                self._tile(rows, wide if whole else wide[columns], ids if whole else ids[columns], None if self.home is None else blocks[which[columns]])
        if self.n_waiting > KEPT * self.k * len(self.ids):
            self.settle()

    def _tile(self, rows: np.ndarray, targets: np.ndarray, ids: np.ndarray, block: np.ndarray | None) -> None:
        scores = self.wide[rows] @ targets.T
        self.multiplied += scores.size
        slack, keep = 2 * 10.0**-SCORE_DIGITS, min(self.k, scores.shape[1])
        near = scores >= self.floor[rows][:, None] - slack
        if np.count_nonzero(near) > 4 * keep * len(rows):  # floors that say little: then the best of this tile
            ranked = np.where(self.ids[rows][:, None] == ids, np.inf, np.nan_to_num(-scores, nan=np.inf))
            near &= scores >= -np.partition(ranked, keep - 1, axis=1)[:, keep - 1, None] - slack
        row, column = np.nonzero(near)
        score = np.round(scores[row, column], SCORE_DIGITS)
        other = (self.ids[rows[row]] != ids[column]) & (score >= self.floor[rows[row]])
        if block is not None:
            other &= self.home[rows[row]] != block[column]
        self.waiting.append((rows[row[other]], ids[column[other]], score[other]))
        self.n_waiting += int(other.sum())

    def settle(self) -> None:
        """Cut what was found to the best of each source, and raise their floors."""
        parts = [(self.row, self.found, self.score), *self.waiting]
        row, found, score = (np.concatenate([p[x] for p in parts]) for x in range(3))
        self.waiting, self.n_waiting = [], 0
        order = np.lexsort((found, -score, row))
        row, found, score = row[order], found[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        self.row, self.found, self.score = row[best], found[best], score[best]
        last = place == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])

    def result(self) -> pa.RecordBatch:
        self.settle()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[self.row], self.found, self.score)], ["item_id", "neighbour_id", "score"])


def best_of_blocks(sources: pa.Table, blocks: Iterator[pa.Table], k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` targets of each source in the blocks. Sources with a ``_floor`` have met the block ``_home`` already."""
    column = lambda name: sources.column(name).to_numpy() if name in sources.column_names else None
    best = Best(column("item_id"), vector_rows(sources.column("embedding").combine_chunks()), k, column("_floor"), column("_home"))
    for piece in blocks:
        block, ids, decay = (piece.column(x).to_numpy() for x in ("_rb", "item_id", "decay"))
        vectors = vector_rows(piece.column("embedding").combine_chunks())
        for at in range(0, len(ids), TILE_TARGETS):
            some = slice(at, at + TILE_TARGETS)
            best.meet(block[some], ids[some], vectors[some], decay[some])
        if best.n_waiting > len(best.ids) * k:
            best.settle()
    yield best.result()


def top_k_per_source(candidates: DataFrame, k: int) -> DataFrame:
    best_first = W.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("neighbour_id"))
    return (
        candidates.withColumn("position", F.row_number().over(best_first)).filter(F.col("position") <= k)
    )


def nearest(items: DataFrame, k: int = config.MAX_RECS, block_rows: int = BLOCK_ROWS, cells: int | None = None) -> DataFrame:
    """``items(item_id, embedding, decay)`` -> ``(item_id, neighbour_id, score, position)``."""
    vectors = items.select(F.col("item_id").cast("long").alias("item_id"), "embedding", "decay")
    n_items = vectors.count()
    index = block_index(vectors, "item_id", "embedding", "decay", n_items, block_rows, cells, unit=True)
    sources = index.rows.withColumnRenamed("_block", "_lb")
    targets = index.rows.withColumnRenamed("_block", "_rb")
    schema = "item_id long, neighbour_id long, score double"

    def work(a, b):
        return best_of_blocks(a, b, k)

    homes = index.rows.select(F.col("_block").alias("_lb"), F.col("_home").alias("_rb"))
    first = tile_apply(homes, sources.select("_lb", "item_id", "embedding"), targets.filter(F.col("_rb") == F.col("_home")).drop("_home"), work, schema)
    if index.n_blocks <= 1:
        return top_k_per_source(first, k)

    first = settle(first)
    floors = first.groupBy("item_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(0.0)).alias("_floor")
    )
    # a source that is alone in its first block has no neighbour there and so no floor yet
    asking = sources.join(floors, "item_id", "left").withColumn("_floor", F.coalesce("_floor", F.lit(0.0)))
    # sources of one group are neighbours in the index, so the same blocks are out of their reach
    n_groups = sweeps(n_items)
    group = F.floor(F.col("_lb") * F.lit(n_groups) / F.lit(index.n_blocks)).cast("int")
    groups = asking.select(group.alias("_lb"), "item_id", "embedding", "_floor", "_home")
    groups = settle(groups)
    wanted = blocks_of_groups(groups.withColumn("_group", F.col("_lb")), index, n_groups, lambda a, b: blocks_in_reach(a, b, k))
    rest = tile_apply(wanted, groups, targets.drop("_home"), work, schema)
    return top_k_per_source(first.unionByName(rest), k)


def article_recs(neighbours: DataFrame, dimension: DataFrame) -> DataFrame:
    """Neighbour pairs of dense item ids -> recommendations keyed by external/article id."""
    source = dimension.select("item_id", F.col("external_id").alias("source_entity_id"))
    target = dimension.select(
        F.col("item_id").alias("neighbour_id"), F.col("article_id").alias("recommended_article_id")
    )
    # a fresh article can be the neighbour of very many others, a source has at most k rows
    named = lookup_join(neighbours.join(source, "item_id"), target, ["neighbour_id"])
    return named.select("source_entity_id", "recommended_article_id", score_decimal(F.col("score")).alias("score"))
