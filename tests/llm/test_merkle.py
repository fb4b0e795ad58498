from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pressroom.llm import merkle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(*values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append(("left" if i & 1 else "right" if i + 1 < len(level) else "none", "".join(level[j] for j in (i ^ 1,) if j < len(level))))
        i >>= 1
    return out


def manifest_by_hand(rows):
    """``[(group, key, leaf, payload)]`` -> one (leaf, subroot, root, path, payload) for each."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, sub = {}, []
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[g] = tree([r[2] for r in groups[g]])
        sub.append(trees[g][-1][0])
    whole = tree(sub)
    return [
        (r[2], trees[g][-1][0], whole[-1][0], siblings(trees[g], i) + siblings(whole, k), r[3])
        for k, g in enumerate(names)
        for i, r in enumerate(groups[g])
    ]


def folded_by_hand(leaf, path):
    for side, other in path:
        leaf = H(other, leaf) if side == "left" else H(leaf, other)
    return leaf


def spark_manifest(df):
    leaf = merkle.digest(F.col("k"), F.col("v"))
    found = merkle.merkle_manifest(df, F.col("g"), [F.col("k")], leaf, F.col("v"))
    return sorted(((r.leaf, r.subroot, r.root, [tuple(s) for s in r.path], r.v) for r in found.collect()), key=repr)


@pytest.mark.parametrize("digits, sizes", [(1, [1, 2, 3, 7, 8, 9]), (2, [5, 1, 17, 4, 16]), (8, [1]), (8, [300, 3]), (3, [1] * 20)])
def test_equals_a_tree_by_hand(session, monkeypatch, digits, sizes):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = [(f"ü{i}" if i else None, k * 7 % size if k % 5 else None, f"v{k}é") for i, size in enumerate(sizes) for k in range(size)]
    df = session.createDataFrame(rows, "g string, k long, v string")
    want = sorted(manifest_by_hand([(g, k, leaf_by_hand(k, v), v) for g, k, v in rows]), key=repr)
    assert spark_manifest(df) == want
    for leaf, _, root, path, _ in want:
        assert folded_by_hand(leaf, path) == root


def test_repeated_rows_have_places_of_their_own(session):
    rows = [("a", 1, "same")] * 700 + [("a", None, None)] * 5 + [("b", 1, "same")]
    df = session.createDataFrame(rows, "g string, k long, v string")
    assert sorted(spark_manifest(df), key=repr) == sorted(manifest_by_hand([(g, k, leaf_by_hand(k, v), v) for g, k, v in rows]), key=repr)


def test_odd_rows_and_no_rows(odd, nothing):
    for df in (odd, nothing):
        leaf = merkle.digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text"))
        clash = df.withColumns({c: F.lit(1) for c in ("g", "m", "rank", "part", "index", "path", "root", "leaf")})
        found = merkle.merkle_manifest(clash, F.col("lang"), [F.col("doc_id")], leaf, F.col("doc_id"), F.col("source")).collect()
        rows = [(r.lang, r.doc_id, leaf_by_hand(r.doc_id, r.source, r.lang, r.n_chars, r.text), (r.doc_id, r.source)) for r in df.collect()]
        want = manifest_by_hand(rows) if rows else []
        got = [(r.leaf, r.subroot, r.root, [tuple(s) for s in r.path], (r.doc_id, r.source)) for r in found]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_by_hand(session):
    sf = "/root/testdata/sf0.001"
    docs = session.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(d.lang, d.doc_id, leaf_by_hand(d.doc_id, d.source, d.lang, d.n_chars, d.text), d) for d in docs]
    want, tampered = {}, 0
    for leaf, subroot, root, path, d in manifest_by_hand(rows):
        chosen = zlib.crc32(str(d.doc_id).encode()) % 7 == 0
        given = leaf_by_hand(d.doc_id, d.source, d.lang, d.n_chars + chosen, d.text)
        tampered += chosen
        up = folded_by_hand(given, path)
        want[d.doc_id] = (d.doc_id, leaf, subroot, root, H(*(s for _, s in path)), up, up == root)
    got = queries.QUERIES["op12_merkle_manifest"](session, sf).collect()
    assert {r.doc_id: tuple(r) for r in got} == want and len(got) == len(docs) and 0 < tampered < len(docs)
