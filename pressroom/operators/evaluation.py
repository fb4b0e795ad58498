"""Hold-out split and mean reciprocal rank."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.functions.vectors import dot, norm
from pressroom.operators.index import block_index, dot_bounds, every_block, matrix, summarised
from pressroom.operators.ordering import total_before
from pressroom.operators.skew import key_counts, lookup_join
from pressroom.operators.tiles import BLOCK_ROWS, sweeps, tile_apply, vector_rows
from pressroom.session import settle

SPLIT_KEY = ["client_id", "article_id", "session_date"]
TRAIN_PERCENT = 80


def held_out_draw(key, seed: int = 0):
    """0 to 99 from the first eight hexadecimal digits of an md5 of seed and key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100


def split_interactions(
    interactions: DataFrame, key=SPLIT_KEY, train_percent: int = TRAIN_PERCENT, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Random split by hash of the row's key: the same row always lands on the same side."""
    draw = held_out_draw(key, seed)
    return interactions.filter(draw < train_percent), interactions.filter(draw >= train_percent)


def ranks(scores: DataFrame, held_out: DataFrame) -> DataFrame:
    """Rank of each held-out ``(user_id, item_id)`` among all scored items of its user,
    best score first, tied scores sharing their average rank. No pair is dropped: an item without a
    score comes after all items of its user, and for a user without any score all items are tied.

    Works on the distinct scores of a user, counted map-side, in sorted ranges, so a user
    with a large share of all rows is ranked by many tasks.
    """
    distinct = scores.groupBy("user_id", "score").agg(F.count(F.lit(1)).alias("_tied"))
    placed = total_before(distinct, ["user_id"], [F.col("score").desc()], F.col("_tied"), "_better")
    wanted = held_out.select("user_id", "item_id").join(
        scores.select("user_id", "item_id", "score"), ["user_id", "item_id"], "left"
    )
    tied = distinct.withColumnRenamed("_tied", "_rows")
    known = lookup_join(wanted.filter("score IS NOT NULL"), placed, ["user_id", "score"], counts=tied).select(
        "user_id", "item_id", "score", (F.col("_better") + (F.col("_tied") + 1) / 2).alias("rank")
    )
    own = distinct.groupBy("user_id").agg(F.sum("_tied").alias("_items"))
    items = scores.agg((F.count_distinct("item_id") + 1) / 2).scalar()
    cold = lookup_join(wanted.filter("score IS NULL"), own, ["user_id"], "left")
    return known.unionByName(cold.select("user_id", "item_id", "score", F.coalesce(F.col("_items") + 1.0, items).alias("rank")))


def mrr_per_user(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("user_id").agg(F.avg(F.lit(1.0) / F.col("rank")).alias("mrr"))


def mrr(ranked: DataFrame) -> DataFrame:
    """One row: the mean over users of their mean reciprocal rank."""
    return mrr_per_user(ranked).agg(F.avg("mrr").alias("mrr"), F.count(F.lit(1)).alias("users"))


SCORE_DIGITS = 6  # the factors are single precision


def thresholds(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For scores and others times 10 to ``SCORE_DIGITS``: what beats a score after rounding is above the first number, what beats or equals it
    is above the second. A half is rounded to the even neighbour."""
    mine = np.rint(scores * 10.0**SCORE_DIGITS)
    odd, above, below = mine % 2 == 1, mine + 0.5, mine - 0.5
    return np.where(odd, np.nextafter(above, -np.inf), above), np.where(odd, below, np.nextafter(below, -np.inf))


def above(scores: np.ndarray, least: np.ndarray) -> np.ndarray:
    """How many scores of each row are above the row's number. Numbers are counted by bits."""
    bits = np.packbits(scores > least[:, None], axis=1)
    return np.bitwise_count(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)).sum(axis=1, dtype=np.int64)


def settled(users: np.ndarray, lowest: np.ndarray, highest: np.ndarray, summaries: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks (columns) may have a score near those of each user, which lie between ``lowest`` and ``highest``, and which are better as a whole. Scores that round
    alike may be equal, so a little more than the rounding is left open."""
    low, high = dot_bounds(users, summaries)
    slack = 2 * 10.0**-SCORE_DIGITS
    better = low > highest[:, None] + slack
    return (high >= lowest[:, None] - slack) & ~better, better


def open_blocks(held_out: pd.DataFrame, summaries: pd.DataFrame) -> pd.DataFrame:
    """Held-out rows once for each block that their own score doesn't settle, and one row each with the number of items in
    blocks that are better as a whole."""
    mine = held_out["score"].to_numpy()
    left, better = settled(matrix(held_out["user_factors"]), mine, mine, summaries)
    row, column = np.nonzero(left)
    rows = held_out[["user_id", "item_id", "user_factors", "score", "_lb"]]
    tiles = rows.iloc[row].assign(_rb=summaries["_block"].to_numpy()[column], better=None)
    whole = rows.assign(user_factors=None, _rb=None, better=better @ summaries["n_rows"].to_numpy())
    return pd.concat([tiles, whole.astype({"_rb": object})]).astype({"_rb": "Int32", "better": "Int64"})


#: Held-out items of a user from which on scores are sorted instead of compared with each.
SORTED_FROM = 12
#: Items of a piece, of a part of a block, and of a product; queries that are settled at once, and of a product, which stays in a core's cache.
TILE_ITEMS, PART_ITEMS, FEW_ITEMS, SETTLED_QUERIES, TILE_QUERIES = 2048, 256, 64, 8192, 1024
#: Share of open queries from which on a part meets all: to leave some out costs more.
MOSTLY_OPEN = 0.85
#: Part of a score that bounds and products, in double precision, may be off.
ROUNDED = 1e-11


class Counting:
    """Counts, for the held-out items of some users, the items that beat them and those that beat or equal them, block by block.

    Row k of ``users`` has the held-out items ``first[k]:first[k + 1]``. ``multiplied`` is the number of scores computed so far.

    Each held-out item of a user with few is a query of its own: the user's vector, and less its own rounded score as a last number that meets a one. So one product tells how far
    all scores lie from its own, and whether they beat or reach it is a comparison of a whole tile with a half. Since a half is rounded to the even
    neighbour, queries of even and of odd scores are apart."""

    def __init__(self, users: np.ndarray, first: np.ndarray, items: np.ndarray, scores: np.ndarray):
        self.users, self.first, self.items = users, first, items
        n, mine = np.diff(first), np.rint(scores * 10.0**SCORE_DIGITS)
        self.row = np.repeat(np.arange(len(users)), n)
        self.above, self.from_ = thresholds(scores)
        self.better, self.reached, self.whole = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64), np.zeros(len(users), np.int64)
        self.by_item = np.argsort(items, kind="stable")
        self.many = np.flatnonzero(n >= SORTED_FROM)
        self.lowest, self.highest = np.minimum.reduceat(scores, first[:-1])[self.many], np.maximum.reduceat(scores, first[:-1])[self.many]
        self.mine, self.length, odd, few = mine, np.linalg.norm(users, axis=1), mine % 2 == 1, n[self.row] < SORTED_FROM
        self.chunks = []
        for places, beats, reaches in ((np.flatnonzero(few & ~odd), np.greater, np.greater_equal), (np.flatnonzero(few & odd), np.greater_equal, np.greater)):
            self.chunks += [(places[at : at + SETTLED_QUERIES], beats, reaches) for at in range(0, len(places), SETTLED_QUERIES)]
        self.products, self.flags = np.empty(FEW_ITEMS * TILE_QUERIES), np.empty(FEW_ITEMS * TILE_QUERIES, bool)
        self.multiplied = 0

    def meet(self, block: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Items with their block; the rows of a block stand together."""
        scaled = vectors * 10.0**SCORE_DIGITS
        owned = self._owned(ids)
        if len(self.many):
            self._meet_many(block, vectors, scaled, owned)
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        blocks = Parts([np.arange(a, b) for a, b in itertools.pairwise(cuts)], scaled)
        parts: dict[int, Parts] = {}
        for places, beats, reaches in self.chunks:
            own = self._index(places, owned[0])
            queries = Queries(self, places, beats, reaches, (own[own >= 0], owned[1][own >= 0]))
            for k, rows in enumerate(queries.settle(blocks)):
                if len(rows) and blocks.sizes[k] > PART_ITEMS:
                    if k not in parts:
                        parts[k] = Parts(halved(scaled, blocks.columns[k], PART_ITEMS), scaled)
                    for j, left in enumerate(queries.settle(parts[k], rows)):
                        queries.compare(parts[k], j, left)
                else:
                    queries.compare(blocks, k, rows)
            self.better[places] += queries.better
            self.reached[places] += queries.reached

    def _owned(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Held-out items that are among these, by row, and where they stand."""
        mine = self.items[self.by_item]
        begin, end = np.searchsorted(mine, ids, "left"), np.searchsorted(mine, ids, "right")
        n = end - begin
        place = self.by_item[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())]
        column = np.repeat(np.arange(len(ids)), n)
        order = np.argsort(place, kind="stable")
        return place[order], column[order]

    def _meet_many(self, block: np.ndarray, vectors: np.ndarray, scaled: np.ndarray, owned: tuple[np.ndarray, np.ndarray]) -> None:
        """Users with many held-out items: their scores are sorted."""
        summaries = summarised(block, vectors)
        sizes = summaries["n_rows"].to_numpy()
        which = np.repeat(np.arange(len(sizes)), sizes)
        left, better = settled(self.users[self.many], self.lowest, self.highest, summaries)
        self.whole[self.many] += better @ sizes
        for k in np.flatnonzero(left.any(axis=1)):
            row, columns = self.many[k], np.flatnonzero(left[k][which])
            held = slice(self.first[row], self.first[row + 1])
            scores = scaled[columns] @ self.users[row]
            self.multiplied += scores.size
            place, column = (x[slice(*np.searchsorted(owned[0], [held.start, held.stop]))] for x in owned)
            at = self._index(columns, column)
            place, at = place[at >= 0], at[at >= 0]
            own = scores[at]
            np.subtract.at(self.better, place, own > self.above[place])
            np.add.at(self.reached, place, own <= self.from_[place])
            line = np.sort(scores)
            self.better[held] += len(line) - np.searchsorted(line, self.above[held], "right")
            self.reached[held] += len(line) - np.searchsorted(line, self.from_[held], "right")

    @staticmethod
    def _index(among: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Where each value stands in a rising array, -1 if nowhere."""
        at = np.minimum(np.searchsorted(among, values), len(among) - 1)
        return np.where(among[at] == values, at, -1)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How many items are better than each held-out one, and how many equal it."""
        return self.better + self.whole[self.row], self.reached - self.better


def halved(vectors: np.ndarray, rows: np.ndarray, most: int) -> list[np.ndarray]:
    """Halves of halves of some rows, cut across where they spread most, until none has more than ``most``."""
    if len(rows) <= most:
        return [rows]
    some = vectors[rows]
    order = np.argpartition(some[:, np.argmax(np.ptp(some, axis=0))], len(rows) // 2)
    return [part for half in (order[: len(rows) // 2], order[len(rows) // 2 :]) for part in halved(vectors, rows[half], most)]


class Parts:
    """Stretches of items of a piece with their bounds."""

    def __init__(self, columns: list[np.ndarray], scaled: np.ndarray):
        self.columns, self.sizes = columns, np.array([len(x) for x in columns])
        self.part, self.place = np.full(len(scaled), -1), np.full(len(scaled), -1)
        every = np.concatenate(columns)
        self.part[every] = np.repeat(np.arange(len(columns)), self.sizes)
        self.place[every] = np.concatenate([np.arange(n) for n in self.sizes])
        sums = summarised(self.part[every], scaled[every])
        self.centre = np.vstack([matrix(sums["centre"]).T, np.ones(len(columns))])
        self.radius, self.longest = sums["radius"].to_numpy(), sums["longest"].to_numpy()
        self.items = [np.column_stack([scaled[x], np.ones(len(x))]) for x in columns]


class Queries:
    """Held-out items, at ``places`` of a ``Counting``, that a piece of items is led past. ``own`` tells which of them are which of the items."""

    def __init__(self, counting: Counting, places: np.ndarray, beats: np.ufunc, reaches: np.ufunc, own: tuple[np.ndarray, np.ndarray]):
        self.counting, self.beats, self.reaches, self.own = counting, beats, reaches, own
        self.mine = counting.mine[places]
        self.length = counting.length[counting.row[places]]
        self.vectors = np.column_stack([counting.users[counting.row[places]], -self.mine])
        self.better, self.reached = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        self.every = np.arange(len(places))
        self.tiles: dict[int, np.ndarray] = {}

    def settle(self, parts: Parts, rows: np.ndarray | None = None) -> list[np.ndarray]:
        """Counts for each query the parts whose every item must beat it, or must equal it once rounded, as a whole. Returns the queries that each part
        leaves open; for all others its items are counted, or must be worse as a whole."""
        some = slice(None) if rows is None or len(rows) == len(self.every) else rows
        rows = self.every[some]
        mine, length = self.mine[some][:, None], self.length[some][:, None]
        middle, far, reach = self.vectors[some] @ parts.centre, length * parts.radius, length * parts.longest
        slack = ROUNDED * (reach + np.abs(mine) + 1)
        low, high = np.maximum(middle - far, -reach - mine) - slack, np.minimum(middle + far, reach - mine) + slack
        beats, worse = low > 0.5, high < -0.5
        counts = beats | ((low > -0.5) & (high < 0.5))
        left = ~(counts | worse)
        whole = left.mean(axis=0) > MOSTLY_OPEN
        for known in (beats, worse, counts):
            known[:, whole] = False
        left[:, whole] = True
        self.better[rows] += beats @ parts.sizes
        self.reached[rows] += counts @ parts.sizes
        # an item ties with itself, also where it has other rows of factors
        own, part = self._own(rows, parts.part[self.own[1]])
        part = part[own >= 0]
        own = own[own >= 0]
        np.subtract.at(self.better, rows[own], beats[own, part])
        np.add.at(self.reached, rows[own], worse[own, part])
        return [rows if w else rows[x] for w, x in zip(whole, left.T, strict=True)]

    def _own(self, rows: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the owners stand among ``rows``, -1 if nowhere or the item isn't in a part."""
        own = self.own[0] if len(rows) == len(self.every) else self.counting._index(rows, self.own[0])
        return np.where(part >= 0, own, -1), part

    def compare(self, parts: Parts, k: int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        every, items = len(rows) == len(self.every), parts.items[k]
        mine = np.flatnonzero(parts.part[self.own[1]] == k)
        own, column = self._own(rows, parts.part[self.own[1]])[0][mine], parts.place[self.own[1][mine]]
        own_of: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for query, item in zip(own.tolist(), column.tolist(), strict=True):
            own_of.setdefault((query // TILE_QUERIES * TILE_QUERIES, item // FEW_ITEMS * FEW_ITEMS), []).append((query, item))
        better, reached = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for at in range(0, len(rows), TILE_QUERIES):
            some = slice(at, at + TILE_QUERIES)
            if every and at not in self.tiles:
                self.tiles[at] = np.ascontiguousarray(self.vectors[some].T)
            queries = self.tiles[at] if every else np.ascontiguousarray(np.take(self.vectors, rows[some], axis=0).T)
            for a in range(0, len(items), FEW_ITEMS):
                few = items[a : a + FEW_ITEMS]
                shape = (len(few), queries.shape[1])
                apart, flags = (x[: shape[0] * shape[1]].reshape(shape) for x in (self.counting.products, self.counting.flags))
                np.matmul(few, queries, out=apart)
                for counted, than, by in ((better, 0.5, self.beats), (reached, -0.5, self.reaches)):
                    by(apart, than, out=flags)
                    counted[some] += np.add.reduce(flags.view(np.uint8), axis=0, dtype=np.uint8)
                if here := own_of.get((at, a)):
                    place, column = np.array(here).T
                    themselves = apart[column - a, place - at]
                    # an item ties with itself
                    np.subtract.at(better, place, self.beats(themselves, 0.5))
                    np.add.at(reached, place, ~self.reaches(themselves, -0.5) & ~np.isnan(themselves))
        self.better[rows] += better
        self.reached[rows] += reached
        self.counting.multiplied += len(rows) * len(items)


def count_better(users: pa.Table, blocks: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """How many items beat or equal each held-out item for its user."""
    held, lists = users.column("item_ids").combine_chunks(), users.column("scores").combine_chunks()
    first = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy())])
    items = held.flatten().to_numpy()
    counting = Counting(vector_rows(users.column("user_factors").combine_chunks()), first, items, lists.flatten().to_numpy())
    for piece in blocks:
        block, ids, vectors = piece.column("_rb").to_numpy(), piece.column("item_id").to_numpy(), vector_rows(piece.column("features").combine_chunks())
        for at in range(0, len(ids), TILE_ITEMS):
            some = slice(at, at + TILE_ITEMS)
            counting.meet(block[some], ids[some], vectors[some])
    better, equal = counting.counts()
    of_user = users.column("user_id").to_numpy()[counting.row]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (of_user, items, better, equal)], ["user_id", "item_id", "better", "equal"])


#: Held-out items of one user that are one row, about.
HELD_ROWS = 8192


def factor_ranks(
    user_factors: DataFrame, item_factors: DataFrame, held_out: DataFrame, block_rows: int = BLOCK_ROWS, cells: int | None = None
) -> DataFrame:
    """Ranks of held-out items among *all* items, straight from the factors.

    Items are cut into blocks by direction and length, and all blocks pass every group of users, with the scores of their held-out items. A block whose every item must score less than
    these counts nothing for a user, one whose every item must score more counts as a whole, and only for blocks in between scores are
    computed, which are counted and forgotten. What is shuffled grows with the users and the items, not with their product. No pair is dropped: an item
    without factors comes after all others, and for a user without factors all items are tied. Such pairs are ``cold``.
    """
    vector = F.transform("features", lambda x: x.cast("double"))
    users = settle(user_factors.select(F.col("id").alias("user_id"), vector.alias("user_factors"), F.monotonically_increasing_id().alias("_user")))
    items = settle(item_factors.select(F.col("id").alias("item_id"), vector.alias("features")))
    pairs = settle(held_out.select("user_id", "item_id").distinct())
    known = lookup_join(pairs, users, ["user_id"])
    own = items.withColumnRenamed("features", "item_factors")
    known = lookup_join(known, own, ["item_id"], counts=key_counts(pairs, ["item_id"]))
    known = settle(known.select("_user", "item_id", dot(F.col("user_factors"), F.col("item_factors")).alias("score")))
    n_items, most = items.count(), known.groupBy("_user").count().agg(F.max("count")).scalar()
    part = F.pmod(F.xxhash64("item_id"), F.ceil(most / F.lit(HELD_ROWS)))
    held = known.groupBy("_user", part.alias("_part")).agg(F.collect_list(F.struct("item_id", "score")).alias("_held"))
    # a user may have several rows of factors
    asking = settle(held.join(users, "_user").select("_user", "_part", "user_id", "user_factors", F.col("_held.item_id").alias("item_ids"), F.col("_held.score").alias("scores")))
    n_left = sweeps(asking.count())
    left = asking.select(F.pmod(F.xxhash64("_user", "_part"), F.lit(n_left)).cast("int").alias("_lb"), "user_id", "user_factors", "item_ids", "scores")
    index = block_index(items.withColumn("length", norm(F.col("features"))), "item_id", "features", "length", n_items, block_rows, cells)
    right = index.rows.select("item_id", "features", F.col("_block").alias("_rb"))
    counted = tile_apply(every_block(index, n_left), left, right, count_better, "user_id int, item_id int, better long, equal long")
    warm = counted.groupBy("user_id", "item_id").agg(
        (F.sum("better") + (F.sum("equal") + 1) / 2).alias("rank"), F.lit(False).alias("cold")
    )
    no_user = lookup_join(pairs, users.select("user_id"), ["user_id"], "left_anti")
    with_user = lookup_join(pairs, users.select("user_id"), ["user_id"], "left_semi")
    no_item = lookup_join(with_user, items.select("item_id"), ["item_id"], "left_anti")
    for rows, rank in ((no_user, (n_items + 1) / 2), (no_item, n_items + 1.0)):
        warm = warm.unionByName(rows.select("user_id", "item_id", F.lit(rank).alias("rank"), F.lit(True).alias("cold")))
    return warm


def factor_mrr(user_factors: DataFrame, item_factors: DataFrame, held_out: DataFrame) -> tuple[float | None, int, int]:
    """Mean reciprocal rank over all held-out pairs, their number, and how many of them were cold."""
    ranked = settle(factor_ranks(user_factors, item_factors, held_out))
    counts = ranked.agg(F.count(F.lit(1)), F.count_if("cold")).first()
    return mrr(ranked).first()["mrr"], counts[0], counts[1]
