"""Runs of repeated words: the same few words again and again, with any period from one word to a quarter of the text.

A run is a stretch of words in which words ``period`` apart are identical, that no neighbouring word extends. Periods are
searched by octave: for the periods from P / 2 to P a document is exploded into overlapping tiles whose length follows P. Within a tile,
Z-functions at boundaries P words apart tell for every such period how far the repetition reaches to both sides; tiles know nothing of each
other, so a very long document is worked on by many tasks. What they find is shuffled by document and period, and touching pieces are
stitched to whole runs.

Why no run is lost: words that match the word ``period`` further on form an interval of at least three periods, hence at least 1.5 P, so it holds
a boundary. A piece ends where the words differ, or P words from its boundary, and then the interval holds the neighbouring boundary too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.llm.words import pieces
from pressroom.session import settle

#: A run has at least so many words, and so many times its period.
LEAST_WORDS = 6
LEAST_REPEATS = 4
#: Boundaries of small octaves share a tile of about so many words.
TILE_WORDS = 512
#: Tiles of so many bytes are worked on by a task.
TASK_BYTES = 1 << 20
_FAR = np.iinfo(np.int64).max

_FOUND = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("span", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
     ("low", pa.int64()), ("wide", pa.bool_()), ("codes", pa.binary())]
)
_PIECES = pa.schema([("row", pa.int64()), ("period", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def _sql(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds.get(f.type, 'array<struct<start: long, length: long, period: long>>')}" for f in schema)


def spaced_words(text: str | None) -> list[bytes]:
    """The words between white space; ``bytes.split`` cuts at space and \\t \\n \\v \\f \\r only."""
    return text.encode().split() if text else []


def _least_matches(period: int) -> int:
    """So many words in a row must equal the word ``period`` further on."""
    return max(LEAST_WORDS, LEAST_REPEATS * period) - period


class _Texts:
    """Texts as numbers: a word's number is the place of its first occurrence in all texts, so equal numbers of one text mean equal words."""

    def __init__(self, texts: list[str | None]):
        self.words = [spaced_words(t) for t in texts]
        self.first = np.concatenate([[0], np.cumsum([len(w) for w in self.words], dtype=np.int64)]).astype(np.int64)
        self.codes = np.empty(self.first[-1], np.int64)
        for words, a, b in zip(self.words, self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            seen: dict[bytes, int] = {}
            self.codes[a:b] = np.fromiter(map(seen.setdefault, words, range(a, b)), np.int64, b - a)

        self.stretches = list(self._stretches())

    def _stretches(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By octave, where every word comes again less than ``span`` words later: no other word can belong to a run with a
        period below ``span``. The last occurrence of a word ends a stretch, so none crosses the end of a text."""
        codes, longest = self.codes, int(np.diff(self.first).max(initial=0))
        again = np.full(len(codes), _FAR)
        order = np.argsort(codes, kind="stable")
        same = codes[order[1:]] == codes[order[:-1]]
        again[order[:-1][same]] = (order[1:] - order[:-1])[same]
        breaks, span = np.arange(len(codes)), 2
        while max(LEAST_WORDS, LEAST_REPEATS * (span // 2)) <= longest:
            breaks = breaks[again[breaks] >= span]
            before = np.concatenate([[-1], breaks[:-1]])
            wide = breaks - before - 1 >= _least_matches(span // 2)
            yield span, before[wide] + 1, breaks[wide]
            span *= 2

    def tiles(self) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
        """``(text, span, first boundary, last boundary, place of the first word, words)`` of every tile, counted within the text."""
        for span, starts, ends in self.stretches:
            step = span * max(1, TILE_WORDS // span)
            owner = np.searchsorted(self.first, starts, side="right") - 1
            for i, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
                base = int(self.first[i])
                s, e, n = s - base, e - base, len(self.words[i])
                codes = self.codes[base : base + n] - base
                at = -(-s // span) * span
                while at <= e:
                    last = min(at // step * step + step - span, e // span * span)
                    low = max(at - span, s)
                    yield i, span, at, last, low, codes[low : min(last + 2 * span, e + span, n)]
                    at = last + span

    def may_repeat(self) -> np.ndarray:
        """Whether a text has any stretch."""
        out = np.zeros(len(self.words), bool)
        for _, starts, _ in self.stretches:
            out[np.searchsorted(self.first, starts, side="right") - 1] = True
        return out


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with a stretch, and all their tiles, each as a row of its own."""
    for piece in pieces(batches, "text"):
        ids, keys, column = piece.column("row").to_pylist(), piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
        texts = _Texts(column)
        rows = [(ids[i], keys[i], column[i], None, None, None, None, None, None) for i in np.flatnonzero(texts.may_repeat())]
        size = 0
        for i, span, at, last, low, codes in texts.tiles():
            wide = len(texts.words[i]) > 1 << 16
            narrow = codes.astype(np.uint32 if wide else np.uint16)
            rows.append((ids[i], None, None, span, at, last, low, wide, narrow.tobytes()))
            size += narrow.nbytes
            if size > 1 << 20 or len(rows) >= 4000:
                yield _batch(_FOUND, rows)
                rows, size = [], 0
        yield _batch(_FOUND, rows)


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the beginning on."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _could_match(codes: np.ndarray, at: int, step: int, span: int) -> bool:
    """Whether some period of the octave fits three words that any long match from ``at`` on, in direction ``step``, has to contain. Of an interval of
    1.5 spans around a boundary, or one that reaches a full span, three quarters of a span lie on one side."""
    low, near = span // 2, np.ones(span - span // 2, bool)
    for offset in {0, (span * 3 // 4 - 1) // 2, max(span * 3 // 4 - 1, 0)}:
        i = at + step * offset
        if i < 0 or i >= len(codes):
            return False
        window = codes[i + low : i + span]
        near[len(window) :] = False
        near[: len(window)] &= window == codes[i]
        if not near.any():
            return False
    return True


def tile_pieces(codes: np.ndarray, low: int, first: int, last: int, span: int) -> list[tuple[int, int, int]]:
    """``(period, start, end)`` of the intervals of matching words at the boundaries of one tile, for periods from span / 2 to span."""
    open_: dict[int, list] = {}
    out: list[tuple[int, int, int]] = []

    def close(period: int, piece: list) -> None:
        start, end, cut = piece
        if cut or end - start >= _least_matches(period):
            out.append((period, start + low, end + low))

    for boundary in range(first, last + 1, span):
        c = boundary - low
        if not (_could_match(codes, c, 1, span) or _could_match(codes, c - 1, -1, span)):
            continue
        right = codes[c : c + 2 * span].tolist()
        left = codes[max(c - span, 0) : c][::-1].tolist()
        after = z_function(right)
        # the same backwards, for the words before the boundary and those that end one period later
        ahead = right[:span][::-1]
        before = z_function([*left, -1, *ahead, *left])
        for period in range(span // 2, span):
            ahead_of = min(after[period], span) if period < len(right) else 0
            back = min(before[len(left) + 1 + len(ahead) - period], span) if period <= len(ahead) else 0
            if not ahead_of + back:
                continue
            start, end = c - back, c + ahead_of
            cut_left, cut_right = back == span, ahead_of == span
            known = open_.get(period)
            if known and known[1] >= start:
                known[1], known[2] = max(known[1], end), known[2] or cut_right
                continue
            if known:
                close(period, known)
            open_[period] = [start, end, cut_left or cut_right]
    for period, piece in open_.items():
        close(period, piece)
    return out


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row, span, first, last, low, wide, codes in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            words = np.frombuffer(codes, np.uint32 if wide else np.uint16).astype(np.int64)
            rows += [(row, *piece) for piece in tile_pieces(words, low, first, last, span)]
        yield _batch(_PIECES, rows)


def stitched(found: DataFrame) -> DataFrame:
    """Pieces -> whole runs ``(row, start, length, period)``. Of equal stretches the smallest period is the run's: a longer one of four
    repeats is a multiple of it."""
    by_period = W.partitionBy("row", "period").orderBy("low", "high")
    reached = F.max("high").over(by_period.rowsBetween(W.unboundedPreceding, -1))
    begins = F.coalesce((F.col("low") > reached).cast("int"), F.lit(1))
    islands = (
        found.distinct()
        .withColumn("begins", begins)
        .withColumn("island", F.sum("begins").over(by_period.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("row", "period", "island")
        .agg(F.min("low").alias("start"), (F.max("high") + F.col("period")).alias("end"))
    )
    long_enough = F.col("end") - F.col("start") >= F.greatest(F.lit(LEAST_WORDS), LEAST_REPEATS * F.col("period"))
    runs = islands.filter(long_enough).groupBy("row", "start", "end").agg(F.min("period").alias("period"))
    return runs.select("row", "start", (F.col("end") - F.col("start")).alias("length"), "period")


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words but those that a run contains after its first period, joined by one space."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words).decode()


def _quiet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The results of texts without a stretch: they have no run."""
    for piece in pieces(batches, "text"):
        keys, texts = piece.column("doc_id").to_pylist(), _Texts(piece.column("text").to_pylist())
        yield _batch(_RESULT, [(keys[i], [], collapse(texts.words[i], [])) for i in np.flatnonzero(~texts.may_repeat())])


def _with_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        rows = []
        for key, text, runs in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "runs")), strict=True):
            spans = [(r["start"], r["length"], r["period"]) for r in runs or []]
            rows.append((key, runs or [], collapse(spaced_words(text), spans)))
        yield _batch(_RESULT, rows)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``runs``, by start, then period, and ``collapsed``, the words that no run repeats.

    A null, empty or blank text has no words, no runs and an empty ``collapsed``. Rows with equal or null ids are told apart, each gets its own
    result, an empty table gives an empty one, and other columns of ``docs`` are not read.
    """
    texts = docs.select("doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = settle(rows.mapInArrow(_explode, _sql(_FOUND)))
    texts_open = found.filter("span IS NULL").select("row", "doc_id", "text")
    tiles = found.filter("span IS NOT NULL").select("row", "span", "first", "last", "low", "wide", "codes")
    # a tile's work is far larger than its bytes, so tasks get few of them
    size = tiles.agg(F.sum(F.octet_length("codes"))).first()[0] or 0
    solved = tiles.repartition(max(1, -(-size // TASK_BYTES)), "row", "span", "first").mapInArrow(_solve, _sql(_PIECES))
    run = F.struct("start", "length", "period")
    by_row = stitched(solved).groupBy("row").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    repeating = texts_open.join(by_row, "row", "left").select("doc_id", "text", "runs").mapInArrow(_with_runs, _sql(_RESULT))
    return texts.mapInArrow(_quiet, _sql(_RESULT)).unionByName(repeating)


def longest_repeat(runs: Column) -> Column:
    """The run with the greatest length / period, compared as fractions; of equal ones the first. Null without runs."""
    better = lambda a, b: F.when(b.length * a.period > a.length * b.period, b).otherwise(a)
    return F.when(F.size(runs) > 0, F.aggregate(runs, F.get(runs, F.lit(0)), better))


def repeated_tail(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic end planted in every document whose id's checksum ends in 0: from word ``a`` on, the words of one period come again.

    The checksum is crc32 of the decimal id; with g = checksum / 10 and n words, a = g mod n and the period is 1 + (n - a) / (3 + g mod 8). Rows without
    an id or without words stay as they are. Of the other columns only doc_id and text are kept.
    """
    checksum = F.crc32(F.col("doc_id").cast("string"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    base = docs.select("doc_id", "text").select("doc_id", "text", F.when(checksum % 10 == 0, split).alias("words"), F.floor(checksum / 10).alias("g"))
    base = base.withColumn("n", F.size("words").cast("long"))
    some = F.col("n") > 0
    base = base.withColumn("a", F.when(some, F.col("g") % F.col("n")))
    base = base.withColumn("period", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("period"))
    places = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    planted = F.array_join(F.transform(places, lambda i: F.get("words", source(i).cast("int"))), " ")
    return base.select("doc_id", F.when(some, planted).otherwise(F.col("text")).alias("text"))
