from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from pressroom.llm import features, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \n\t.é漢-_", max_size=40)), max_size=6)


def cut(column, kind, lower=False):
    w = words.words(column, kind, lower)
    return [[w.data[a:b].tobytes().decode() for a, b in zip(w.starts[i:j], w.ends[i:j], strict=True)] for i, j in zip(w.first[:-1], w.first[1:], strict=True)]


@given(TEXTS)
def test_words_equal_the_patterns(texts):
    column = pa.array(texts, pa.string())
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    assert cut(column, words.SPACED) == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert cut(column, words.ALPHANUMERIC, True) == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in low]


@given(TEXTS)
def test_hashes_are_equal_for_equal_words(texts):
    column = pa.array(texts, pa.string())
    w = words.words(column, words.SPACED)
    flat = [x for t in cut(column, words.SPACED) for x in t]
    hashes = w.hashes().tolist()
    assert len(set(zip(flat, hashes, strict=True))) == len(set(flat)) == len(set(hashes))


def test_very_long_words_have_the_hash_of_their_bytes():
    texts = ["a" * 400_000 + "b", "a" * 400_000 + "c", "q " + "a" * 400_000 + "b"]
    w = words.words(pa.array(texts), words.SPACED)
    h = w.hashes()
    assert h[0] == h[3] != h[1]


def test_windows_of_texts():
    w = words.words(pa.array(["a b c d e f", "a b c", "", "b c d e f"]), words.SPACED)
    hashes, first = words.windows(w.hashes(), w.first, 5)
    assert np.diff(first).tolist() == [2, 1, 0, 1]
    assert hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3


def test_pieces_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"id": list(range(50)), "text": ["x" * (i % 7) * 10 for i in range(50)]})
    parts = list(words.pieces(iter([batch]), "text", 100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(50)) and len(parts) > 5


@given(TEXTS)
def test_line_and_window_counts(texts):
    column = pa.array(texts, pa.string())
    w = words.words(column, words.SPACED)
    n_lines, n_again = features.lines(column, w.starts)
    repeated = features.repeated_words(w.hashes(), w.first, 2)
    for i, t in enumerate(texts):
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert n_lines[i] == len(lines) and n_again[i] == len(lines) - len(set(lines))
        found = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        pairs = list(zip(found, found[1:], strict=False))
        covered = {j + k for j, p in enumerate(pairs) if pairs.count(p) > 1 for k in (0, 1)}
        assert repeated[i] == len(covered)
