"""Benchmark decontamination with a distributed positional inverted index.

The index is a table with one row for each segment, a few megabytes of whole documents: the sorted terms, and the ascending
positions of each term. It holds the terms that a test asks for; they are recognised by a bit table of fixed size, whose false hits only
make the index larger. Test items come in blocks of bounded size. For a window of test words, the positions of its rarest term, less
the term's place in the item, are the diagonals on which the window can lie; the offset-adjusted lists of the next
rarest terms are intersected with them, and what is left is followed over the whole item. An inverted list from each window's rarest term
to its items names the few items that a segment has to be searched for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import words
from pressroom.session import settle

#: Consecutive item words that make a window.
WINDOW = 10
#: Words of test items that are looked up at once.
BLOCK_WORDS = 1 << 22
#: Bits of the table of terms that are indexed.
TERM_BITS = 1 << 22
#: A near match has the rarest terms of a window within so many words, and such a share (in tenths) of all its distinct terms.
REACH, NEAR_TERMS, NEAR_TENTHS = 20, 3, 7
#: Free positions between two documents of a segment, so that nothing is found across them.
_GAP = 2 * REACH + WINDOW

_SEGMENT = "segment long, doc_id array<long>, n_words array<int>, terms binary, ends binary, positions binary"
_MATCH = "segment long, doc int, doc_id long, item_id string, first int, last int, kind string"


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items to the hashes of their words."""
    for batch in batches:
        cut = words.words(batch.column(1), words.ALPHANUMERIC, lower=True)
        ids = batch.column(0).cast(pa.string()).fill_null("null")
        yield pa.RecordBatch.from_arrays([ids, pa.array(cut.counts), words.blobs(cut.hashes(), cut.first)], ["item_id", "n", "terms"])


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [np.frombuffer(x.as_buffer(), np.uint64) % np.uint64(TERM_BITS) for x in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([np.zeros(0, np.uint64), *values])).astype(np.int64))], ["bit"])


def _bases(n_words: np.ndarray) -> np.ndarray:
    """The position of each document's first word in its segment."""
    return _GAP + np.concatenate([[0], np.cumsum(n_words + _GAP)])


def _index(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for piece in words.pieces(batches, "text"):
            cut = words.words(piece.column(1), words.ALPHANUMERIC, lower=True)
            hashes = cut.hashes()
            at = np.arange(len(hashes)) - np.repeat(cut.first[:-1] - _bases(cut.counts)[:-1], cut.counts)
            keep = wanted[hashes % np.uint64(TERM_BITS)]
            hashes, at = hashes[keep], at[keep].astype(np.int32)
            order = np.argsort(hashes, kind="stable")
            hashes, at = hashes[order], at[order]
            ends = np.append(np.flatnonzero(hashes[1:] != hashes[:-1]) + 1, len(hashes))[: len(hashes)]
            one = lambda values: words.blobs(values, [0, len(values)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([segment]),
                    words.list_array(piece.column(0), [0, piece.num_rows], pa.int64()),
                    words.list_array(cut.counts, [0, piece.num_rows], pa.int32()),
                    one(hashes[ends - 1]),
                    one(ends.astype(np.int32)),
                    one(at),
                ],
                ["segment", "doc_id", "n_words", "terms", "ends", "positions"],
            )
            segment += 1

    return run


def positional_index(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The segments of ``docs (doc_id, text)`` with the positions of the words of ``items``, written as a table."""
    wanted = np.zeros(TERM_BITS, bool)
    for batch in items.select("terms").mapInArrow(_bits, "bit long").distinct().toLocalIterator():  # TERM_BITS rows at most
        wanted[batch["bit"]] = True
    return settle(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_index(wanted), _SEGMENT))


@dataclass
class Block:
    """Some items: their distinct terms, each item's words as numbers of terms, and how often each term occurs in the index."""

    ids: list[str]
    terms: np.ndarray
    numbers: np.ndarray
    first: np.ndarray
    frequency: np.ndarray

    def item(self, i: int) -> np.ndarray:
        return self.numbers[self.first[i] : self.first[i + 1]]


@dataclass
class Leads:
    """The rarest occurring terms of the windows of a block: ``terms[k]`` are those of some windows of item ``owner[k]``, rarest first (the number of
    terms where a window has fewer); ``starts[first[k]:first[k + 1]]`` are these windows. ``first_of[i]:first_of[i + 1]`` are item i's."""

    owner: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    first_of: np.ndarray

    @classmethod
    def of(cls, block: Block, size: int) -> Leads:
        none = len(block.terms)
        owner, terms, starts, number, first_of = [], [], [], [], [0]
        for i in range(len(block.ids)):
            item = block.item(i)
            windows = np.lib.stride_tricks.sliding_window_view(item, min(size, len(item)))
            by_term = np.argsort(windows, axis=1, kind="stable")
            sorted_terms = np.take_along_axis(windows, by_term, 1)
            again = np.zeros(windows.shape, bool)
            np.put_along_axis(again, by_term[:, 1:], sorted_terms[:, 1:] == sorted_terms[:, :-1], 1)
            often = block.frequency[windows]
            rank = np.where(again | (often == 0), np.iinfo(np.int64).max, often * size + np.arange(windows.shape[1]))
            rarest = np.argsort(rank, axis=1, kind="stable")[:, :NEAR_TERMS]
            lead = np.full((len(windows), NEAR_TERMS), none)
            there = np.take_along_axis(rank, rarest, 1) < np.iinfo(np.int64).max
            lead[:, : rarest.shape[1]] = np.where(there, np.take_along_axis(windows, rarest, 1), none)
            distinct, which, n = np.unique(lead, axis=0, return_inverse=True, return_counts=True)
            owner.append(np.full(len(distinct), i))
            terms.append(distinct)
            starts.append(np.argsort(which.reshape(-1), kind="stable"))
            number.append(n)
            first_of.append(first_of[-1] + len(distinct))
        first = np.concatenate([[0], np.cumsum(np.concatenate(number))])
        return cls(np.concatenate(owner), np.concatenate(terms), first, np.concatenate(starts), np.array(first_of))


def _block(rows) -> Block:
    rows = [(row["item_id"], np.frombuffer(row["terms"], np.uint64)) for row in rows]
    terms, numbers = np.unique(np.concatenate([x for _, x in rows]), return_inverse=True)
    first = np.concatenate([[0], np.cumsum([len(x) for _, x in rows])])
    return Block([i for i, _ in rows], terms, numbers, first, np.zeros(len(terms), np.int64))


class Segment:
    """The positions of a block's terms in one segment."""

    def __init__(self, row: dict, block: Block):
        terms, ends = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["ends"], np.int32)
        self.positions = np.frombuffer(row["positions"], np.int32)
        begins = np.concatenate([[0], ends])
        at = np.minimum(np.searchsorted(terms, block.terms), max(len(terms) - 1, 0))
        self.present = terms[at] == block.terms if len(terms) else np.zeros(len(block.terms), bool)
        self.begin = np.where(self.present, begins[at], 0)
        self.end = np.where(self.present, begins[np.minimum(at + 1, len(begins) - 1)], 0)

    def of(self, term: int) -> np.ndarray:
        return self.positions[self.begin[term] : self.end[term]]

    def has(self, term: int, places: np.ndarray) -> np.ndarray:
        """Which places the term stands at."""
        there = self.of(term)
        if not len(there):
            return np.zeros(len(places), bool)
        return there[np.minimum(np.searchsorted(there, places), len(there) - 1)] == places

    def within(self, term: int, places: np.ndarray, reach: int) -> np.ndarray:
        there = self.of(term)
        return np.searchsorted(there, places - reach) < np.searchsorted(there, places + reach, side="right")


def phrases(segment: Segment, item: np.ndarray, frequency: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The runs (first, last position) of a segment that windows of an item cover."""
    size = min(size, len(item))
    windows = np.lib.stride_tricks.sliding_window_view(item, size)
    whole = np.flatnonzero(segment.present[windows].all(axis=1))
    diagonals, done = [], set()
    for w in whole:
        order = np.argsort(frequency[windows[w]], kind="stable")
        rarest, second = w + order[0], w + order[min(1, size - 1)]
        if (rarest, second) not in done:
            done.add((rarest, second))
            starts = segment.of(item[rarest]) - rarest
            diagonals.append(starts[segment.has(item[second], starts + second)])
    if not diagonals:
        return []
    starts = np.unique(np.concatenate(diagonals))
    places = np.unique(whole[:, None] + np.arange(size))
    same = np.zeros((len(starts), len(item) + 1), np.int32)
    for j in places[np.argsort(frequency[item[places]], kind="stable")]:
        same[:, j + 1] = segment.has(item[j], starts + j)
    sums = np.cumsum(same, axis=1)
    d, w = np.nonzero(sums[:, size:] - sums[:, :-size] == size)
    if not len(d):
        return []
    # windows that follow one another on a diagonal are one run
    fresh = np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] > w[:-1] + size)])
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(d) - 1)
    return list(zip((starts[d] + w)[fresh].tolist(), (starts[d[last]] + w[last] + size - 1).tolist(), strict=True))


def near(segment: Segment, item: np.ndarray, groups: list[tuple[np.ndarray, np.ndarray]], size: int, reach: int) -> np.ndarray:
    """Positions of the rarest term of a window, around which its next rarest terms and enough of all its terms stand in any order.

    ``groups`` are the rarest terms of windows, and where these windows begin in the item."""
    size = min(size, len(item))
    found = []
    for leads, starts in groups:
        places = segment.of(leads[0])
        for term in leads[1:]:
            places = places[segment.within(term, places, reach)]
        if not len(places):
            continue
        for w in starts:
            terms = np.unique(item[w : w + size])
            there = sum(segment.within(term, places, reach).astype(int) for term in terms)
            found.append(places[10 * there >= NEAR_TENTHS * len(terms)])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def _search(block: Block, leads: Leads, size: int, reach: int):
    by_term = np.argsort(leads.terms[:, 0], kind="stable")
    lists = np.searchsorted(leads.terms[by_term, 0], np.arange(len(block.terms) + 1))
    complete = leads.terms[:, -1] < len(block.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row, block)
                bases = _bases(np.array(row["n_words"], np.int64))
                out = []
                # the items of which a window's rarest term is here
                here = np.flatnonzero(segment.present & (lists[1:] > lists[:-1]))
                asked = by_term[np.concatenate([np.arange(0), *(np.arange(lists[t], lists[t + 1]) for t in here)])]
                every = np.append(segment.present, False)[leads.terms].all(axis=1) & complete
                for i in np.unique(leads.owner[asked]).tolist():
                    item, name = block.item(i), block.ids[i]
                    runs = phrases(segment, item, block.frequency, size)
                    out += [(name, a, b, "phrase") for a, b in runs]
                    if reach:
                        covered = np.sort(np.array(runs, np.int64).reshape(-1, 2), axis=0)
                        mine = np.arange(leads.first_of[i], leads.first_of[i + 1])
                        groups = [(leads.terms[k], leads.starts[leads.first[k] : leads.first[k + 1]]) for k in mine[every[mine]]]
                        places = near(segment, item, groups, size, reach)
                        k = np.searchsorted(covered[:, 0], places, side="right") - 1
                        inside = (k >= 0) & (places <= covered[:, 1][k]) if len(covered) else np.zeros(len(places), bool)
                        out += [(name, p, p, "near") for p in places[~inside].tolist()]
                if out:
                    names, first, last, kinds = (list(x) for x in zip(*out, strict=True))
                    doc = np.searchsorted(bases, first, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["segment"]] * len(doc)),
                            pa.array(doc, pa.int32()),
                            pa.array([row["doc_id"][d] for d in doc], pa.int64()),
                            pa.array(names),
                            pa.array(np.array(first) - bases[doc], pa.int32()),
                            pa.array(np.array(last) - bases[doc], pa.int32()),
                            pa.array(kinds),
                        ],
                        ["segment", "doc", "doc_id", "item_id", "first", "last", "kind"],
                    )

    return run


def _frequencies(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for there, ends in zip(batch.column(0), batch.column(1), strict=True):
                there, ends = np.frombuffer(there.as_buffer(), np.uint64), np.frombuffer(ends.as_buffer(), np.int32)
                if len(there):
                    at = np.minimum(np.searchsorted(there, terms), len(there) - 1)
                    total += np.where(there[at] == terms, np.diff(ends, prepend=0)[at], 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    return run


def matches(index: DataFrame, items: DataFrame, size: int = WINDOW, reach: int = REACH) -> DataFrame:
    """Exact and near matches of the items in the indexed documents, with the first and last word of each.

    ``kind`` is ``phrase`` for a run that windows of the item cover word by word. ``near`` is a place of a window's rarest term outside of such a run
    with the next two rarest within ``reach`` words, and seven tenths of all the window's distinct terms. Rarest are terms with the fewest occurrences
    in the index, but some, and of equally many the first in the window; a window with fewer than three such terms has no near matches.
    """
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))
    out = index.sparkSession.createDataFrame([], _MATCH)
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == b).filter("n > 0").collect()
        if rows:
            block = _block(rows)
            counts = index.select("terms", "ends").mapInArrow(_frequencies(block.terms), "at long, n long")
            for row in counts.groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():  # the block's terms at most
                block.frequency[row["at"]] = row["n"]
            out = out.union(index.mapInArrow(_search(block, Leads.of(block, size), size, reach), _MATCH))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, reach: int = REACH) -> DataFrame:
    """``docs (doc_id, text)`` against ``benchmark (item_id, text)``: one row for each row of ``docs``.

    ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``n_items`` and ``item_ids`` (items with occurring windows),
    ``n_near`` (places of near matches, for each item) and ``contaminated``. Null or empty texts have no words; such items match nothing. Items with
    equal ids count once, a null item_id is the id ``null``. Rows with equal doc_id are documents of their own. Other columns are ignored.
    """
    items = settle(benchmark.select(F.col("item_id"), "text").mapInArrow(_terms, "item_id string, n long, terms binary"))
    index = positional_index(docs, items)
    found = settle(matches(index, items, size, reach))
    exact = F.col("kind") == "phrase"
    runs = F.array_sort(F.collect_list(F.when(exact, F.struct("first", "last"))))
    covered = F.aggregate(
        runs,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("reached")),
        lambda a, run: F.struct(
            (a.n + F.greatest(run["last"] - F.greatest(run["first"] - 1, a.reached), F.lit(0))).alias("n"),
            F.greatest(a.reached, run["last"]).alias("reached"),
        ),
    )
    by_doc = found.groupBy("segment", "doc").agg(
        covered.n.alias("n_hit"),
        F.array_sort(F.collect_set(F.when(exact, F.col("item_id")))).alias("item_ids"),
        F.count(F.when(~exact, 1)).alias("n_near"),
    )
    each = index.select("segment", F.posexplode(F.arrays_zip("doc_id", "n_words")).alias("doc", "of"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return each.join(by_doc, ["segment", "doc"], "left").select(
        F.col("of.doc_id").alias("doc_id"),
        F.col("of.n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    )
