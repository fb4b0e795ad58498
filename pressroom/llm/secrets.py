"""Secret scans: fixed patterns, and a character network that judges every other long token with its surroundings.

The findings of the patterns in a bounded sample of documents are the labels: tokens inside one are secrets, other long tokens and
ordinary words are not. Half of the positive examples come without their surroundings, so that the network also knows a
secret by its own characters. Part of the sample is kept for calibration and the threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import words
from pressroom.llm.charnet import BEFORE, LENGTH, NOTHING, CharNet, window

#: Fixed patterns; the letters of the key words are taken in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "learned")

#: Characters of a candidate, and its shortest length.
TOKEN = np.zeros(256, bool)
TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
LEAST_TOKEN = 16
#: Documents the network learns from at most; the share of known secrets that its threshold has to find; the fewest examples of each kind
#: without which there is no network, and the most of each kind that it is fitted on.
SAMPLE_DOCUMENTS, RECALL, LEAST_EXAMPLES, MOST_EXAMPLES = 20_000, 0.95, 8, 4000

SPANS = "array<struct<kind:string,start:long,end:long>>"


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, in code points."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN] if ":" in text or "=" in text else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(column: pa.Array) -> list[list[tuple[int, int]]]:
    """For each text, the long tokens with a letter and a digit, in code points."""
    cut = words.words(column, TOKEN)
    _, offsets = words.text_bytes(column)
    long = np.flatnonzero(cut.ends - cut.starts >= LEAST_TOKEN)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    owner = np.searchsorted(cut.first, long, side="right") - 1
    for k, i in zip(long, owner, strict=True):
        start, end = int(cut.starts[k]), int(cut.ends[k])
        token = cut.data[start:end]
        digits = (token >= 48) & (token <= 57)
        if digits.any() and not digits.all() and ((token >= 65) & ~digits).any():
            before = cut.data[offsets[i] : start]
            at = int(np.count_nonzero((before & 0xC0) != 0x80))
            out[i].append((at, at + end - start))
    return out


def _overlaps(start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(a < end and start < b for a, _, b in spans)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of secrets (1), of other long tokens and of one ordinary word for each text (0)."""
    for piece in words.pieces(batches, "text"):
        rows, y = [], []
        column = piece.column(piece.schema.get_field_index("text"))
        for text, tokens in zip(column.to_pylist(), candidates(column), strict=True):
            if not text:
                continue
            spans = base_findings(text)
            for start, end in tokens:
                rows.append(window(text, start, end))
                y.append(int(_overlaps(start, end, spans)))
            for word in list(re.finditer(r"\S+", text[:4000]))[1::97]:
                if not _overlaps(*word.span(), spans):
                    rows.append(window(text, *word.span()))
                    y.append(0)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in rows]), pa.array(y, pa.int32())], ["x", "y"])


def train(docs: DataFrame, rows: int = SAMPLE_DOCUMENTS) -> CharNet:
    """The network, fitted on documents chosen by a hash of their id; without enough examples it finds nothing."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text")  # rows are bounded
    examples = sample.mapInArrow(_examples, "x binary, y int").distinct().toArrow()
    x = np.frombuffer(b"".join(examples.column("x").to_pylist()), np.uint8).reshape(-1, LENGTH)
    y = examples.column("y").to_numpy()
    order = np.lexsort((*x.T, y))  # the order in which rows arrive doesn't matter
    x, y = x[order], y[order]
    net = CharNet.fresh()
    if min(np.sum(y == 1), np.sum(y == 0)) < LEAST_EXAMPLES:
        return net
    random = np.random.default_rng(5)
    each = [random.permutation(np.flatnonzero(y == label))[:MOST_EXAMPLES] for label in (0, 1)]
    kept = np.zeros(len(y), bool)
    kept[np.concatenate([of[: max(1, len(of) // 3)] for of in each])] = True
    of = np.sort(np.concatenate(each))
    x, y, kept = x[of], y[of], kept[of]
    fit, labels = x[~kept], y[~kept]
    bare = fit[labels == 1].copy()
    bare[:, :BEFORE] = NOTHING
    net.fit(np.concatenate([fit, bare]), np.concatenate([labels, np.ones(len(bare), labels.dtype)]))
    net.calibrate(x[kept], y[kept], RECALL)
    return net


def _spans(column: pa.Array, net: CharNet) -> list[list[tuple[int, int, int]]]:
    """All findings of each text, by start and kind."""
    texts = [text or "" for text in column.to_pylist()]
    found = [base_findings(text) for text in texts]
    asked, where = [], []
    if net.threshold <= 1:
        for i, tokens in enumerate(candidates(column)):
            for start, end in tokens:
                if not _overlaps(start, end, found[i]):
                    asked.append(window(texts[i], start, end))
                    where.append((i, start, end))
    if asked:
        for (i, start, end), p in zip(where, net.probability(np.stack(asked)), strict=True):
            if p >= net.threshold:
                found[i].append((start, 3, end))
    return [sorted(x) for x in found]


def _scan(net: CharNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in x] for x in _spans(piece.column(1), net)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return run


def secret_spans(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` to ``(doc_id, spans)``, one row for each row of ``docs``.

    ``spans`` are ``(kind, start, end)`` in code points, the end exclusive, by start and then kind: the pattern kinds ``assign``, ``access``, ``hex``, and
    ``learned`` for what the network adds; it adds nothing that overlaps a pattern's finding. Null and empty texts have none. Rows with equal or null
    ids are documents of their own; other columns are ignored; an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan(train(docs)), f"doc_id long, spans {SPANS}")


def _redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, kind, end in spans:
        if end > at:
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind]}]"]
            at = end
    return "".join([*out, text[at:]])


def _redact(net: CharNet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            k = piece.schema.get_field_index("text")
            column = piece.column(k)
            texts = [text if text is None else _redacted(text, spans) for text, spans in zip(column.to_pylist(), _spans(column, net), strict=True)]
            yield piece.set_column(k, piece.schema.field(k), pa.array(texts, column.type))

    return run


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each secret of ``text`` replaced by its kind in brackets; all other columns and all rows stay as they are.

    Findings that overlap become one replacement, named after the first. Null stays null.
    """
    return docs.mapInArrow(_redact(train(docs)), docs.schema)
