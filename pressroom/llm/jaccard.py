"""Join of documents whose word shingles have a large Jaccard similarity, with adaptive multi-match prefixes.

1. A shingle that only one document has cannot be shared. Shingles are dealt out by hash, and each document learns how
   many of its shingles occur elsewhere. With fewer than the threshold asks for, it links with nothing.
2. Equal sets become one class.
3. The classes that are left order their shingles by an estimate of how common they are, rarest first. Two sets that
   link share at least ``m`` shingles of the first ``n - ceil(t * n) + m`` of each. Each set chooses its own ``m``: a longer prefix costs
   more list entries, but a candidate then needs ``m`` shared ones, which leaves at most (entries / m) candidates. A pair needs the smaller of its two ``m``.
4. First each class is compared with one other, the class that leads most of its lists. Groups that this joins need no more
   comparisons within them; all other pairs that share enough prefix shingles are verified on their whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import words
from pressroom.llm.components import components
from pressroom.session import settle

SHINGLE = 5
#: Similarity of two sets that link, in percent.
PERCENT = 75
#: Shingles that one group of the counting step holds, on average.
GROUP = 1 << 19
#: Counters of the estimate of how common a shingle is: a fixed size, and only an order and a cost follow from it.
COUNTERS = 1 << 18
#: The longest lengthening of a prefix that is considered, and what a comparison costs in list entries for each shingle.
MOST_MATCHES, COMPARE_COST = 16, 0.05
_KNOWN = 0xFFFF


def needed(n, percent: int = PERCENT):
    """The fewest shared shingles with which a set of ``n`` can link."""
    return (n * percent + 99) // 100


def needed_of_both(n: int, k: int, percent: int = PERCENT) -> int:
    """The fewest shared shingles with which sets of ``n`` and ``k`` link."""
    return ((n + k) * percent + 99 + percent) // (100 + percent)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and where each text's begin."""
    cut = words.words(column, words.SPACED, lower=True)
    shingles, first = words.windows(cut.hashes(), cut.first, size)
    return words.distinct_by_owner(first, shingles)


def signatures(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent sums over each set: equal sets have equal ones."""
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words.mixed(values ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


_DEALT = (
    "bucket long, chunk long, low binary, local binary, doc_id array<long>, n array<int>, s1 array<long>, s2 array<long>, "
    "text_hash array<long>, known array<int>"
)
_FOUND = "chunk long, found binary, doc_id array<long>, n array<int>, s1 array<long>, s2 array<long>, text_hash array<long>, known array<int>"
_LISTS = {"doc_id": pa.int64(), "n": pa.int32(), "s1": pa.int64(), "s2": pa.int64(), "text_hash": pa.int64(), "known": pa.int32()}


def _deal(bits: int, size: int):
    """Rows of (bucket, chunk): the shingles of a few documents whose hash begins with the bucket's bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for piece in words.pieces(batches, "text"):
            for at in range(0, piece.num_rows, _KNOWN - 1):
                part = piece.slice(at, _KNOWN - 1)
                values, first = shingle_sets(part.column(1), size)
                s1, s2 = signatures(values, first)
                n = np.diff(first)
                local = np.repeat(np.arange(len(n)), n)
                order = np.argsort(values)
                values, local = values[order], local[order]
                begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else values.astype(int)
                runs = np.diff(np.append(begins, len(values)))
                known = np.bincount(local[np.repeat(runs > 1, runs)], minlength=len(n))
                # one entry for each shingle of the chunk, however many of its documents have it
                values, local = values[begins], np.where(runs > 1, _KNOWN, local[begins]).astype(np.uint16)
                buckets = values >> np.uint64(64 - bits) if bits else np.zeros(len(values), np.uint64)
                cuts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(values) else begins
                ends = np.append(cuts, len(values))
                low = ((values >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                lists = [part.column(0).cast(pa.int64()), n, s1, s2, part.column(2), known]
                yield _batch(
                    [buckets[cuts].astype(np.int64), np.full(len(cuts), chunk), words.blobs(low, ends), words.blobs(local, ends)],
                    [pa.nulls(len(cuts), pa.list_(kind)) for kind in _LISTS.values()],
                )
                yield _batch(
                    [np.array([-1 - chunk % (1 << 52)]), np.array([chunk]), words.blobs(low[:0], np.zeros(2)), words.blobs(local[:0], np.zeros(2))],
                    [words.list_array(x, [0, len(n)], kind) for x, kind in zip(lists, _LISTS.values(), strict=True)],
                )
                chunk += 1

    def _batch(scalars, lists):
        names = ["bucket", "chunk", "low", "local", *_LISTS]
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in scalars] + lists, names)

    return run


def _blob(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of all binaries of a column, and where each one's begin."""
    parts = [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind) for chunk in column.chunks for x in chunk]
    first = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), first


def _meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each chunk of a bucket, the documents that have a shingle which another chunk has too, once for each such shingle."""
    if key[0].as_py() < 0:
        found = pa.nulls(table.num_rows, pa.binary())
    else:
        low, first = _blob(table.column("low"), np.uint32)
        local, _ = _blob(table.column("local"), np.uint16)
        order = np.argsort(low, kind="stable")
        ordered = low[order]
        same = np.zeros(len(low) + 1, bool)
        same[1:-1] = ordered[1:] == ordered[:-1]
        shared = np.zeros(len(low), bool)
        shared[order] = same[1:] | same[:-1]
        shared &= local != _KNOWN
        counts = np.concatenate([[0], np.cumsum(shared)])
        found = words.blobs(local[shared], counts[first])
    return pa.table([table.column("chunk"), found, *(table.column(c) for c in _LISTS)], ["chunk", "found", *_LISTS])


def _sum_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One row for each document of a chunk."""
    row = next(i for i, x in enumerate(table.column("n")) if x.is_valid)
    lists = {c: table.column(c)[row].values for c in _LISTS}
    found, _ = _blob(table.column("found"), np.uint16)
    shared = lists.pop("known").to_numpy(zero_copy_only=False) + np.bincount(found, minlength=len(lists["n"]))
    return pa.table([*lists.values(), pa.array(shared, pa.int32())], ["doc_id", "n", "s1", "s2", "text_hash", "shared"])


def shared_shingles(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs (doc_id, text)`` to one row each: ``n`` shingles, signatures, a hash of the text, and how many shingles other documents have too.

    Shingles travel as 4 bytes within a bucket, and once for each chunk of documents, so a shingle
    that every document has adds an entry for each chunk and not for each document. Hash collisions can only make a shingle look shared.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(31, max(0, math.ceil(math.log2(max(1, total / 6 / GROUP)))))
    dealt = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(_deal(bits, size), _DEALT)
    met = dealt.groupBy("bucket").applyInArrow(_meet, _FOUND)
    return met.groupBy("chunk").applyInArrow(_sum_up, "doc_id long, n int, s1 long, s2 long, text_hash long, shared int")


def _whole_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            values, first = shingle_sets(piece.column(piece.schema.get_field_index("text")), size)
            s1, s2 = signatures(values, first)
            mine = (piece.column("s1").to_numpy() == s1) & (piece.column("s2").to_numpy() == s2)
            out = pa.RecordBatch.from_arrays([piece.column("node"), pa.array(np.diff(first), pa.int32()), words.blobs(values, first)], ["node", "n", "shingles"])
            yield out.filter(pa.array(mine))

    return run


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for blob in batch.column(0):
            np.add.at(counts, np.frombuffer(blob.as_buffer(), np.uint64) % np.uint64(COUNTERS), 1)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "count"])


def prefix(shingles: np.ndarray, common: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set, rarest first by the estimate ``common``, and how many of its shingles a candidate has to share."""
    n = len(shingles)
    order = np.lexsort((shingles, common))
    cost = np.cumsum(common[order], dtype=np.float64)
    shortest = n - needed(n, percent) + 1
    m = np.arange(1, min(MOST_MATCHES, n - shortest + 1) + 1)
    entries = cost[shortest + m - 2]
    best = int(np.argmin(entries + entries / m * (1 + COMPARE_COST * n)))
    return shingles[order[: shortest + best]], best + 1


def _prefixes(common: np.ndarray, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, matches = [], []
            for blob in batch.column("shingles"):
                shingles = np.frombuffer(blob.as_buffer(), np.uint64)
                part, m = prefix(shingles, common[shingles % np.uint64(COUNTERS)], percent)
                parts.append(part.view(np.int64))
                matches.append(m)
            first = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
            lists = words.list_array(np.concatenate([np.zeros(0, np.int64), *parts]), first, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), pa.array(matches, pa.int32()), lists], ["node", "n", "matches", "prefix"]
            )

    return run


def _enough(percent: int):
    """Pairs whose prefixes share as many shingles as both ask for, and as many as their sizes ask for with all that is left of a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            columns = [batch.column(c) for c in ("x_n", "y_n", "x_matches", "y_matches")]
            for x, y, n, k, m, o in zip(batch.column("x"), batch.column("y"), *(c.to_pylist() for c in columns), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                x = x[: n - needed_of_both(n, n, percent) + m]  # the smaller set needs a shorter one
                both = len(np.intersect1d(x, y, assume_unique=True))
                left = max(n - len(x), k - len(y))
                ok.append(both >= min(m, o) and both + left >= needed_of_both(n, k, percent))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets link."""
    side = lambda name, blob: sets.select(F.col("node").alias(name), F.col("shingles").alias(blob))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(_compare(percent), "a long, b long")


def _mixed(entries: DataFrame, joined: DataFrame) -> DataFrame:
    """The entries with their groups, of the lists that more than one group has entries in."""
    placed = entries.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    return placed.join(mixed.select("shingle"), "shingle")


def _led(entries: DataFrame) -> DataFrame:
    """For each class, the other class that leads most of its lists. The class that meets most others leads a list: copies with changes have
    rare shingles that the original hasn't."""
    lists = entries.groupBy("shingle").agg(F.max(F.struct("met", "node")).alias("leader"))
    led = entries.join(lists, "shingle").filter("node <> leader.node")
    led = led.groupBy(F.col("node").alias("a"), F.col("leader.node").alias("b")).agg(F.count("*").alias("lists"), F.max("leader.met").alias("met"))
    return led.groupBy("a").agg(F.max(F.struct("lists", "met", "b")).alias("best")).select("a", F.col("best.b").alias("b"))


def _candidates(entries: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes of different groups whose prefixes share enough.

    Sets that link share at least ``asked`` = t / (1 + t) of the sum of their sizes, so at least one shingle of the prefix for a single match. The
    set with no more shingles than its partner needs a shorter one. What two sets share is no more than what each shares with
    anybody, and no more than what is left of either from their first shared shingle on. The pairs that this leaves compare their lengthened prefixes.
    """
    whole = 100 + percent
    asked = f"floor(({percent} * (x.n + y.n) + {whole - 1}) / {whole})"
    on = f"""x.shingle = y.shingle AND x.root <> y.root AND (x.n < y.n OR (x.n = y.n AND x.node < y.node)) AND 100 * x.n >= {percent} * y.n
        AND x.place <= x.n - floor(({2 * percent} * x.n + {whole - 1}) / {whole}) AND least(x.shared, y.shared) >= {asked}
        AND least(x.n - x.place, y.n - y.place) >= {asked}"""
    pairs = entries.alias("x").join(entries.alias("y"), F.expr(on)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    side = lambda c, d: prefixes.select(*(F.col(k).alias(v) for k, v in {"node": c, "prefix": d, "n": f"{d}_n", "matches": f"{d}_matches"}.items()))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(_enough(percent), "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``docs (doc_id, text)`` to ``(doc_id, n_shingles, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links, the document's own included. Texts that are null or
    have no words have no shingles and stand alone. Rows with equal doc_id are
    documents of their own; a null doc_id is never the smallest unless all are null. Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    sets = settle(shared_shingles(docs, size))
    classes = settle(
        sets.filter("n > 0")
        .groupBy("s1", "s2", "n")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first"), F.max("shared").alias("shared"))
        .select("s1", "s2", "n", F.col("first.doc_id").alias("smallest"), F.col("first.text_hash").alias("text_hash"), "shared")
        .withColumn("node", F.monotonically_increasing_id())
    )
    alive = classes.filter(f"shared * 100 >= n * {percent}")
    # rows with one id may be in many classes, but those with the same text are all in one
    first = alive.select(F.col("smallest").alias("first"), "text_hash", "node", "s1", "s2")
    whole = settle(
        docs.join(first, F.col("doc_id").eqNullSafe(F.col("first")) & (F.xxhash64("text") == F.col("text_hash")))
        .select("node", "s1", "s2", "text")
        .mapInArrow(_whole_sets(size), "node long, n int, shingles binary")
        .dropDuplicates(["node"])
    )
    counted = whole.select("shingles").mapInArrow(_counters, "at long, count long").groupBy("at").agg(F.sum("count").alias("count"))
    common = np.ones(COUNTERS, np.int64)
    for row in counted.toLocalIterator():  # at most COUNTERS rows
        common[row["at"]] = row["count"]

    prefixes = settle(whole.mapInArrow(_prefixes(common, percent), "node long, n int, matches int, prefix array<long>"))
    single = F.slice("prefix", F.lit(1), F.expr(f"int(n - floor(({percent} * n + 99) / 100) + 1)"))
    entries = prefixes.select("node", "n", F.posexplode(single).alias("place", "shingle"))
    lists = entries.groupBy("shingle").agg(F.count("*").alias("length")).filter("length > 1")
    entries = settle(entries.join(lists, "shingle"))
    met = entries.groupBy("node").agg(F.sum("length").alias("met")).join(classes.select("node", "shared"), "node")
    entries = settle(entries.drop("length").join(met, "node"))

    joined = components(settle(_verify(_led(entries), whole, percent)))
    pairs = _candidates(_mixed(entries, joined), prefixes, percent)
    more = settle(_verify(pairs, whole, percent))
    roots = components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))

    placed = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    labels = placed.join(smallest, "root").select("s1", "s2", F.col("n").alias("size"), "component_id")
    on = (sets.s1 == labels.s1) & (sets.s2 == labels.s2) & (sets.n == labels.size)
    return sets.join(labels, on, "left").select(
        sets.doc_id,
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(sets.doc_id).alias("component_id"),
    )
