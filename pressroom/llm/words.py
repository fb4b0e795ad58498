"""Words of whole texts as numpy arrays.

Texts come as the bytes of one Arrow column, so a batch is cut into words by a handful of array
operations instead of a Python loop. Both kinds of words are defined on bytes: every byte of a non-ASCII
character is 0x80 or more, so a class that takes all non-ASCII characters takes all those bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about so many bytes, which bounds a task's memory. One longer text is a
#: piece of its own.
PIECE_BYTES = 2 << 20
#: Word hashes are computed over so many bytes at a time, so that the arrays stay in the processor's cache.
_SPAN = 1 << 17


def _table(separators) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words between white space: anything but space and \t \n \v \f \r.
SPACED = _table([0x20, *range(0x09, 0x0E)])
#: Words of letters and digits: ASCII letters and digits, and everything that is not ASCII.
ALPHANUMERIC = _table([b for b in range(0x80) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240131)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_random.integers(1, 2**62)) * 8 + 5
_ORDER = _random.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _SPAN + 1)
_DOWN = _powers(pow(_BASE, -1, 2**64), _SPAN + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and where each text begins (one more for the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, (offsets - offsets[0]).astype(np.int64)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut into slices whose texts have about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """All words of some texts, in order. ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        out = np.empty(len(self.starts), np.uint64)
        i, n = 0, len(out)
        while i < n:
            begin = self.starts[i]
            j = int(np.searchsorted(self.ends, begin + _SPAN, side="right"))
            if j <= i:  # one word longer than the span
                out[i], i = self._long(i), i + 1
                continue
            end = self.ends[j - 1]
            sums = np.zeros(end - begin + 1, np.uint64)
            np.cumsum(_BYTE[self.data[begin:end]] * _UP[: end - begin], out=sums[1:])
            a, b = self.starts[i:j] - begin, self.ends[i:j] - begin
            out[i:j] = mixed((sums[b] - sums[a]) * _DOWN[a] + (b - a).astype(np.uint64))
            i = j
        return out

    def _long(self, i: int) -> np.uint64:
        """The same hash of one very long word, span by span."""
        total, factor = 0, 1
        for at in range(int(self.starts[i]), int(self.ends[i]), _SPAN):
            part = self.data[at : min(at + _SPAN, int(self.ends[i]))]
            total += factor * int(np.sum(_BYTE[part] * _UP[: len(part)], dtype=np.uint64))
            factor = factor * int(_UP[_SPAN]) % 2**64
        return mixed(np.array([(total + int(self.ends[i] - self.starts[i])) % 2**64], np.uint64))[0]


def words(column: pa.Array, kind: np.ndarray, lower: bool = False) -> Words:
    """Cut every text of a column into words of the given kind; ``lower`` turns A-Z into a-z first."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    # a text may end within a word while the next begins with one: cut there
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(data))])
    inner = inner[inside[inner] & inside[inner + 1]]
    if len(inner):
        starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words inside one text, and the first such window of each text. A text
    with fewer words, but not none, is one window."""
    counts = np.diff(first)
    number = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(number)])
    at = np.arange(begins[-1]) + np.repeat(first[:-1] - begins[:-1], number)
    full = np.repeat(counts >= size, number)
    out = np.zeros(len(at), np.uint64)
    if full.all():
        for k in range(size):
            out += hashes[at + k] * _ORDER[k]
    else:
        length = np.minimum(np.repeat(counts, number), size)
        for k in range(size):
            there = length > k
            out[there] += hashes[at[there] + k] * _ORDER[k]
        out += (~full).astype(np.uint64) * length.astype(np.uint64) * _ORDER[63]
    return mixed(out), begins


def distinct_by_owner(first: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text in ascending order, and the first of each text."""
    kept = [np.unique(values[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)]
    begins = np.concatenate([[0], np.cumsum([len(x) for x in kept], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(kept) if kept else values[:0]), begins


def blobs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Arrow binaries: binary i holds the bytes of ``values[first[i]:first[i + 1]]``."""
    offsets = (np.asarray(first, np.int64) * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )


def list_array(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow lists: list i is ``values[first[i]:first[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(first, np.int32)), pa.array(values, kind))
