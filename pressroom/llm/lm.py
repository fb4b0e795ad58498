"""Language-model scores of whole documents: counts of single words, and a gated recurrent network.

All words of the training documents are counted. Frequent words, a fixed number, are known to every task; the others meet their counts in a join.
Then every text is cut into words once more, and written as the numbers its words have in the network; training and scoring read these.
The network knows the most frequent words, as many as make up three quarters of the corpus; any other word is one symbol to it, times its share among those words. It is trained where the data is: every
task trains on its documents, a share of them in each round until all were read, and the weights are averaged by tokens after each round, in two steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import labels, recurrent, words
from pressroom.session import settle

FOLDS, HELD_OUT = 7, 2
#: Words whose counts every task knows, and most words the network knows: of these, the most frequent that make up such a share of all tokens.
FREQUENT, VOCABULARY, COVERED = 100_000, 100_000, 0.75
#: Rounds of averaging. Each trains the network on another share of the training documents, and together they read every one once.
SHARE = 4
#: Tokens of texts that are scored together, and that are trained on together.
SCORE_TOKENS, TRAIN_TOKENS = 5 << 19, 5 << 18
#: Sums of weights that are built for each block of weights before they meet in one.
PARTIAL = 64
#: The hash that stands for the end of a document.
END = np.uint64(0x1E5D0C0E)
#: Words a task counts before it passes its counts on.
_COUNTED = 1 << 21
#: Frequent words are looked up by the first 17 bits of their hashes.
_BUCKET_SHIFT = np.uint64(47)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each text's words and its end, and where each text's begin."""
    cut = words.words(column, words.SPACED, lower=True)
    first = cut.first + np.arange(len(cut.first))
    out = np.full(first[-1], END, np.uint64)
    owner = cut.owner()
    out[np.arange(len(owner)) + owner] = cut.hashes()
    return out, first


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return values, np.bincount(at, np.concatenate([n for _, n in parts]), minlength=len(values)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def rows():
        values, n = _merged(parts)
        for at in range(0, len(values), 1 << 16):
            some = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(values[some].view(np.int64)), pa.array(n[some])], ["word", "n"])

    for piece in words.pieces(batches, "text"):
        parts.append(np.unique(_tokens(piece.column(0))[0], return_counts=True))
        if sum(len(v) for v, _ in parts) > _COUNTED:
            parts = [_merged(parts)]
            if len(parts[0][0]) > _COUNTED // 2:
                yield from rows()
                parts = []
    if parts:
        yield from rows()


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)``: how often each word, by its hash, and the end stand in ``texts (text)``."""
    return texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """The counts of frequent words by hash, totals, and the network's numbering of its words."""

    word: np.ndarray
    n: np.ndarray
    total: int
    distinct: int
    number: np.ndarray
    other: int
    word_class: np.ndarray
    class_counts: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame) -> Counts:
        total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
        top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()  # a fixed number of rows
        word, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
        total, distinct = int(total or 0), int(distinct or 0)
        known = min(VOCABULARY, len(word), int(np.searchsorted(np.cumsum(n), COVERED * total)) + 1)
        # words of the network in falling order of counts, with one symbol for all others
        sizes = np.append(n[:known], max(1, total - int(n[:known].sum())))
        order = np.argsort(-sizes, kind="stable")
        numbers = np.empty(known + 1, np.int64)
        numbers[order] = np.arange(known + 1)
        number = np.full(len(word), numbers[known])
        number[:known] = numbers[:known]
        by_hash = np.argsort(word)
        word_class = recurrent.classes(sizes[order], round(known ** (2 / 3)) + 1)
        word_class = np.unique(word_class, return_inverse=True)[1]
        return cls(word[by_hash], n[by_hash], total, distinct, number[by_hash], int(numbers[known]), word_class, sizes[order])

    @cached_property
    def _buckets(self) -> np.ndarray:
        """Where the words begin whose hashes have the same first bits."""
        return np.searchsorted(self.word >> _BUCKET_SHIFT, np.arange((1 << 17) + 1, dtype=np.uint64))

    @property
    def kind(self) -> np.dtype:
        """What the numbers of the words are written as."""
        return np.dtype(np.uint16 if len(self.class_counts) <= 1 << 16 else np.int32)

    def numbers(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of each text's words, and where each text's begin."""
        data, first = words.text_bytes(column)
        return data.view(self.kind).astype(np.int32), first // self.kind.itemsize

    @property
    def other_total(self) -> int:
        """What the counts plus one of all words that the network doesn't know, and of one unseen word, add up to."""
        known = len(self.class_counts) - 1
        inside = int(self.n[self.number != self.other].sum())
        return self.total - inside + self.distinct - known + 1

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each word, 0 for one that isn't frequent, and its number in the network."""
        if not len(self.word):
            return np.zeros(len(hashes), np.int64), np.full(len(hashes), self.other)
        bucket = hashes >> _BUCKET_SHIFT
        at, end = self._buckets.take(bucket), self._buckets.take(bucket + np.uint64(1))
        there = self.word.take(at, mode="clip") == hashes
        left = np.flatnonzero(~there & (at + 1 < end))
        while len(left):
            at[left] += 1
            there[left] = self.word[at[left]] == hashes[left]
            left = left[~there[left] & (at[left] + 1 < end[left])]
        at[~there] = 0
        return np.where(there, self.n[at], 0), np.where(there, self.number[at], self.other)


def _number(counts: Counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            hashes, first = _tokens(piece.column(1))
            n, ids = counts.look_up(hashes)
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
            each = lambda weights: np.bincount(owner, weights, minlength=len(first) - 1)
            logs = np.log10(n + 1.0)
            # words that aren't frequent wait for their counts
            rare = n == 0
            begins = np.concatenate([[0], np.cumsum(rare)])[first]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array(np.diff(first)),
                    pa.array(each(n > 0).astype(np.int64)),
                    pa.array(each(logs)),
                    pa.array(each(np.where(ids == counts.other, logs - np.log10(counts.other_total), 0))),
                    words.blobs(ids.astype(counts.kind), first),
                    words.list_array(hashes[rare].view(np.int64), begins, pa.int64()),
                ],
                ["doc_id", "n_tokens", "n_known", "base", "other", "ids", "rare"],
            )

    return run


def numbered(docs: DataFrame, counts: Counts) -> DataFrame:
    """``docs (doc_id, text)`` with the numbers of all words in the network, what frequent words and those that the network doesn't know add to the scores, and the
    hashes of the words that aren't frequent."""
    schema = "doc_id long, n_tokens long, n_known long, base double, other double, ids binary, rare array<long>"
    return docs.select("doc_id", "text").mapInArrow(_number(counts), schema)


def _train(counts: Counts, flat: np.ndarray | None, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = recurrent.Model.fresh(counts.word_class, counts.class_counts)
        trainer = recurrent.Trainer(model if flat is None else model.with_flat(flat))
        for piece in words.pieces(batches, "ids", TRAIN_TOKENS * counts.kind.itemsize):
            trainer.train(*counts.numbers(piece.column(0)))
        if trainer.tokens:
            new = trainer.model.flat() * np.float32(trainer.tokens)
            cuts = np.append(np.arange(0, len(new), block), len(new))
            lists = words.list_array(new, cuts, pa.float32())
            n = len(lists)
            part = np.full(n, TaskContext.get().partitionId() % PARTIAL)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(part), lists, pa.array(np.full(n, trainer.tokens))], ["block", "part", "w", "tokens"])

    return run


_WEIGHTS = "block long, part long, w array<float>, tokens long"


def _sum(parts: pa.Table) -> pa.Table:
    """The sum of the weights of one block, and of their tokens."""
    total = np.zeros(len(parts.column("w")[0]), np.float64)
    for w in parts.column("w"):
        total += w.values.to_numpy()
    tokens = int(parts.column("tokens").to_numpy().sum())
    lists = pa.array([total.astype(np.float32)], pa.list_(pa.float32()))
    return pa.table({"block": parts.column("block")[:1], "part": parts.column("part")[:1], "w": lists, "tokens": pa.array([tokens])})


def train(docs: DataFrame, counts: Counts, block: int = 4096) -> recurrent.Model:
    """Training on ``docs (doc_id, text)``."""
    return train_on(numbered(docs, counts), counts, block)


def train_on(texts: DataFrame, counts: Counts, block: int = 4096) -> recurrent.Model:
    """Training in every task on ``texts (doc_id, ids)``, a share in each round, begun with the average of the weights before."""
    model = recurrent.Model.fresh(counts.word_class, counts.class_counts)
    flat = None
    share = F.pmod(F.xxhash64("doc_id", F.lit("lm")), F.lit(SHARE))
    for k in range(SHARE):
        parts = texts.filter(share == k).select("ids").mapInArrow(_train(counts, flat, block), _WEIGHTS)
        sums = parts.groupBy("block", "part").applyInArrow(_sum, _WEIGHTS).groupBy("block").applyInArrow(_sum, _WEIGHTS)
        found = sums.toArrow()  # as many numbers as weights
        if not found.num_rows:
            continue
        found = found.take(pa.array(np.argsort(found.column("block").to_numpy())))
        flat = found.column("w").combine_chunks().flatten().to_numpy() / np.float32(found.column("tokens")[0].as_py())
    return model if flat is None else model.with_flat(flat)


def _score(counts: Counts, model: recurrent.Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "ids", SCORE_TOKENS * counts.kind.itemsize):
            neural = recurrent.score(model, *counts.numbers(piece.column(1))) / np.log(10)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(neural)], ["row", "neural"])

    return run


def lm_scores(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` to ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row for each row of ``docs``.

    Both scores are log10 probabilities of the whole text and its end. A null or empty text is its end alone. Rows with equal ids are
    documents of their own; a row with a null id is not held out. Without training documents no word is known, and the network is as it was
    before training. Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    learned = docs.filter(~labels.held_out(FOLDS, HELD_OUT))
    counts = settle(word_counts(learned.select("text")))
    known = Counts.of(counts)
    texts = settle(numbered(docs, known).withColumn("row", F.monotonically_increasing_id()))
    held_out = labels.held_out(FOLDS, HELD_OUT)
    model = train_on(texts.filter(~held_out), known)
    scored = settle(texts.select("row", "ids").mapInArrow(_score(known, model), "row long, neural double"))
    asked = texts.select("row", F.explode("rare").alias("word"))
    found = asked.join(counts, "word").groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("logs"))
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return texts.drop("ids", "rare").join(scored, "row").join(found, "row", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * float(np.log10(known.total + known.distinct + 1))).alias("base_score"),
        (F.col("neural") + F.col("other") + logs).alias("score"),
    )
