from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pressroom.llm import periods, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words):
    """All runs, straight from their definition."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed_by_hand(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted_by_hand(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def runs_of(text):
    """The library's own steps without Spark: tiles, pieces, and stitching as the windows do it."""
    t = periods._Texts([text])
    pieces = set()
    for _, span, first, last, low, codes in t.tiles():
        pieces.update(periods.tile_pieces(codes, low, first, last, span))
    runs, by_period = {}, {}
    for q, s, e in sorted(pieces):
        mine = by_period.setdefault(q, [])
        if mine and s <= mine[-1][1]:
            mine[-1][1] = max(mine[-1][1], e)
        else:
            mine.append([s, e])
    for q in sorted(by_period):
        for s, e in by_period[q]:
            if e + q - s >= max(6, 4 * q):
                runs.setdefault((s, e + q), q)
    assert bool(runs) <= bool(t.may_repeat()[0])
    return sorted((s, e - s, q) for (s, e), q in runs.items())


@given(st.lists(st.sampled_from("abc"), max_size=120))
@settings(max_examples=300, deadline=None)
def test_runs_of_few_letters(words):
    assert runs_of(" ".join(words)) == runs_by_hand(words)


@given(st.randoms(use_true_random=False))
@settings(max_examples=150, deadline=None)
def test_planted_runs(rng):
    words = []
    while len(words) < rng.choice([20, 300, 3000]):
        words += [rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(rng.randrange(40))]
        period = [rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.choice([1, 2, 3, 5, 8, 17, 64, 65, 130, 257]))]
        length = rng.randrange(2 * len(period), 7 * len(period) + 2)
        words += (period * 8)[:length]
    assert runs_of(" ".join(words)) == runs_by_hand(words)


@pytest.mark.parametrize("tile", [2, 16, 512])
def test_tiles_of_any_size_give_the_same_runs(tile, monkeypatch):
    monkeypatch.setattr(periods, "TILE_WORDS", tile)
    rng = random.Random(5)
    words = [rng.choice("ab") for _ in range(400)] + list("abcab" * 60) + ["x"] * 700 + [str(i % 150) for i in range(900)]
    assert runs_of(" ".join(words)) == runs_by_hand(words)


@given(st.lists(st.integers(0, 2), max_size=60))
def test_z_function(s):
    z = periods.z_function(s)
    for i in range(1, len(s)):
        k = 0
        while i + k < len(s) and s[k] == s[i + k]:
            k += 1
        assert z[i] == k


def result_by_hand(doc_id, text):
    words = planted_by_hand(doc_id, WORD.findall(text or ""))
    runs = runs_by_hand(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, sha(lines), sha(collapsed_by_hand(words, runs)))


def test_query_equals_the_definition(session):
    docs = session.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120).select("doc_id", "text").collect()
    got = queries.QUERIES["op11_periodic_runs"](session, "/root/testdata/sf0.001").collect()
    mine = {r.doc_id: tuple(r) for r in got}
    assert len(got) == session.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    small = [d for d in docs if len(d.text) < 8000]
    assert len(small) > 50 and any(mine[d.doc_id][1] for d in small)
    for d in small:
        assert mine[d.doc_id] == result_by_hand(d.doc_id, d.text)


def test_odd_texts(odd):
    got = [(r.doc_id, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periods.periodic_runs(odd).collect()]
    want = []
    for r in odd.collect():
        words = WORD.findall(r.text or "")
        runs = [(0, 40_000, 1)] if r.text and r.text.startswith("long") else runs_by_hand(words)
        want.append((r.doc_id, tuple(runs), collapsed_by_hand(words, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_no_rows_and_planting_of_odd_rows(nothing, odd):
    assert periods.periodic_runs(nothing).collect() == []
    planted = periods.repeated_tail(odd)
    assert planted.columns == ["doc_id", "text"] and planted.count() == odd.count()
    for r in planted.filter("doc_id is null").collect():
        assert r.text in (None, "no id")


def test_planting_equals_its_formula(session):
    rng = np.random.default_rng(3)
    rows = [(int(i), " ".join(f"w{x}" for x in rng.integers(0, 99, i % 37)) + " \t") for i in range(400)]
    got = periods.repeated_tail(session.createDataFrame(rows, "doc_id long, text string")).collect()
    changed = 0
    for r, (i, text) in zip(sorted(got), rows, strict=True):
        assert WORD.findall(r.text) == planted_by_hand(i, WORD.findall(text))
        changed += r.text != text
    assert changed > 20
