"""Counts and rates of whole texts, computed for all texts of an Arrow batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pressroom.llm import words

#: Fixed classes of ASCII bytes; a byte is counted once, in the first class that has it.
CLASSES = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "digit": "0123456789",
    "symbol": "#*$%&|<>",
    "exclaim": "!?",
    "stop": ".,;:",
    "space": " \t\n\v\f\r",
}
_CLASS = np.full(256, len(CLASSES) + 1, np.uint8)
_CLASS[0x80:] = len(CLASSES)
for _k, _letters in enumerate(CLASSES.values()):
    _CLASS[[ord(c) for c in _letters]] = _k
#: Lines: everything between line feeds.
LINES = np.ones(256, bool)
LINES[0x0A] = False
WINDOW = 5


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of ``values[first[i]:first[i + 1]]`` for each i."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def byte_classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, the bytes of each class; then non-ASCII and other bytes."""
    n, k = len(offsets) - 1, len(CLASSES) + 2
    owner = np.repeat(np.arange(n, dtype=np.int64) * k, np.diff(offsets))
    return np.bincount(owner + _CLASS[data], minlength=n * k).reshape(n, k)


def code_points(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """For each text, the characters whose first byte is of a kind."""
    return sums(kind[data] & ((data & 0xC0) != 0x80), offsets)


def again(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur twice or more in their text, and which are equal to an earlier one."""
    twice, later = np.zeros(len(values), bool), np.zeros(len(values), bool)
    for i, j in zip(first[:-1], first[1:], strict=True):
        if j - i > 1:
            part = values[i:j]
            order = np.argsort(part, kind="stable")
            same = part[order[1:]] == part[order[:-1]]
            if same.any():
                later[i + order[1:][same]] = True
                twice[i + order[1:][same]] = True
                twice[i + order[:-1][same]] = True
    return twice, later


def repeated_words(hashes: np.ndarray, first: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """For each text, the words inside windows of ``size`` words that it has twice or more."""
    window, begins = words.windows(hashes, first, size)
    twice, _ = again(window, begins)
    at = np.flatnonzero(twice)
    if not len(at):
        return np.zeros(len(first) - 1, np.int64)
    owner = np.searchsorted(begins, at, side="right") - 1
    start = first[owner] + at - begins[owner]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, np.minimum(start + size, len(hashes)), -1)
    return sums(np.cumsum(change[:-1]) > 0, first)


def lines(column: pa.Array, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text, the lines with a word (words begin at ``starts``), and those equal to an earlier line."""
    cut = words.words(column, LINES)
    full = np.searchsorted(starts, cut.ends) > np.searchsorted(starts, cut.starts)
    first = np.concatenate([[0], np.cumsum(full)])[cut.first]
    _, later = again(cut.hashes()[full], first)
    return np.diff(first), sums(later, first)


NAMES = [
    "log_words",
    "log_bytes",
    "word_length",
    "word_spread",
    "short_words",
    "capital_words",
    "symbol_words",
    "same_as_last",
    "repeated_words",
    "distinct_words",
    "log_lines",
    "repeated_lines",
    *(f"{name}_rate" for name in CLASSES),
    "wide_rate",
    "other_rate",
    "any_symbol",
    "any_exclaim",
    "any_repeated",
]


def dense(column: pa.Array) -> np.ndarray:
    """One row of rates for each text, as ``NAMES`` lists them. A text without words has zeros."""
    cut = words.words(column, words.SPACED)
    data, offsets = words.text_bytes(column)
    n = cut.counts
    some = np.maximum(n, 1)
    length = (cut.ends - cut.starts).astype(np.float64)
    mean = sums(length, cut.first) / some
    upper = np.concatenate([[0], np.cumsum(_CLASS[data] == 0)])
    symbol = np.concatenate([[0], np.cumsum((_CLASS[data] == 3) | (_CLASS[data] == 4))])
    hashes = cut.hashes()
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[cut.first[:-1][n > 0]] = False
    distinct = np.diff(words.distinct_by_owner(cut.first, hashes)[1])
    repeated = repeated_words(hashes, cut.first)
    n_lines, n_again = lines(column, cut.starts)
    classes = byte_classes(data, offsets)
    rates = classes / np.maximum(np.diff(offsets), 1)[:, None]
    return np.column_stack(
        [
            np.log1p(n),
            np.log1p(np.diff(offsets)),
            mean,
            np.sqrt(np.maximum(sums(length**2, cut.first) / some - mean**2, 0)),
            sums(length <= 3, cut.first) / some,
            sums(upper[cut.ends] - upper[cut.starts] > 1, cut.first) / some,
            sums(symbol[cut.ends] > symbol[cut.starts], cut.first) / some,
            sums(same, cut.first) / some,
            repeated / some,
            distinct / some,
            np.log1p(n_lines),
            n_again / np.maximum(n_lines, 1),
            rates,
            classes[:, 3] > 0,
            classes[:, 4] > 0,
            repeated > 0,
        ]
    ).astype(np.float64)
