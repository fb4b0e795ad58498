from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest

from pressroom.llm import decontaminate, words


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items):
    out = []
    for doc, text in docs:
        found, hit, names = cut(text), set(), set()
        for item, wording in items:
            w = cut(wording)
            k = min(len(w), 10)
            windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
            for i in range(len(found) - k + 1) if k else ():
                if tuple(found[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    names.add(str(item) if item is not None else "null")
        out.append((doc, len(found), len(hit), len(names), ",".join(sorted(names))))
    return sorted(out, key=repr)


def near_by_brute_force(docs, items):
    """Places of near matches by document, tried for every window and word."""
    texts = [(d, cut(text)) for d, text in docs]
    frequency = collections.Counter(w for _, text in texts for w in text)
    out = collections.Counter()
    for _, wording in items:
        w = cut(wording)
        k = min(len(w), 10)
        windows = [w[i : i + k] for i in range(len(w) - k + 1)] if k else []
        for doc, text in texts:
            inside = {i + j for i in range(len(text) - k + 1) if text[i : i + k] in windows for j in range(k)} if k else set()
            places = set()
            for window in windows:
                lead = sorted((x for x in set(window) if frequency[x]), key=lambda x: (frequency[x], window.index(x)))[:3]
                if len(lead) == 3:
                    for p in (p for p, x in enumerate(text) if x == lead[0]):
                        around = set(text[max(0, p - 20) : p + 21])
                        if around.issuperset(lead) and 10 * len(around & set(window)) >= 7 * len(set(window)):
                            places.add(p)
            out[doc] += len(places - inside)
    return out


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r.item_ids)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [3, 4])
def test_phrases(session, monkeypatch, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Éa", "the", "THE"]
    some = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(i, some(draw.choice([0, 1, 2, 9, 10, 11, 25]))) for i in range(12)]
    docs = []
    for d in range(40):
        text = some(draw.randrange(60))
        for _ in range(draw.randrange(3)):
            item = draw.choice(items)[1]
            a = draw.randrange(len(item) + 1)
            at = draw.randrange(len(text) + 1)
            text[at:at] = item[a : a + draw.choice([5, 10, 14, 30])]
        docs.append((d, draw.choice([" ", ", ", "-"]).join(text)))
    items = [(i, " ".join(w)) for i, w in items]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)  # several blocks of items
    got = decontaminate.decontaminate(session.createDataFrame(docs, "doc_id long, text string"), session.createDataFrame(items, "item_id long, text string"))
    assert result(got) == brute_force(docs, items)


def test_near_matches(session):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, "so kappa and iota or theta, eta zeta; epsilon delta gamma beta alpha"), (2, item), (3, "alpha and nothing else")]
    index_items = session.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near > 0) for r in decontaminate.decontaminate(session.createDataFrame(docs, "doc_id long, text string"), index_items).collect()}
    assert got == {1: (0, True), 2: (10, False), 3: (0, False)}


def test_near_matches_equal_brute_force(session, monkeypatch):
    draw = random.Random(11)
    some = lambda n, of=200: [f"w{int(of * draw.random() ** 2)}" for _ in range(n)]
    items = [(i, some(draw.choice([2, 3, 8, 12, 30]))) for i in range(10)]
    items.append((10, ["never", "seen", *some(12)]))
    docs = []
    for d in range(60):
        text = some(draw.randrange(80))
        for _ in range(2):
            item = draw.choice(items)[1]
            a = draw.randrange(len(item))
            part = item[a : a + 14]
            for _ in range(draw.randrange(4)):  # words replaced or moved
                part[draw.randrange(len(part))] = draw.choice([*some(1), "other", *part])
            at = draw.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((d, " ".join(text)))
    items = [(i, " ".join(w)) for i, w in items]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    monkeypatch.setattr(words, "PIECE_BYTES", 2000)
    got = decontaminate.decontaminate(session.createDataFrame(docs, "doc_id long, text string"), session.createDataFrame(items, "item_id long, text string"))
    expected = near_by_brute_force(docs, items)
    assert {r.doc_id: r.n_near for r in got.collect()} == {d: expected[d] for d, _ in docs} and sum(expected.values()) > 10


def test_a_passage_with_a_replaced_word_is_near(session):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = [(1, "we read " + item.replace("zeta", "unheard") + " today"), (2, "nothing of it")]
    one = session.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near > 0) for r in decontaminate.decontaminate(session.createDataFrame(docs, "doc_id long, text string"), one).collect()}
    assert got == {1: (0, True), 2: (0, False)}


def test_odd_rows(session, odd, nothing):
    items = [(1, None), (2, ""), (2, "word"), (None, "five six seven eight nine ten eleven"), (2, "the same id"), (3, "no id")]
    benchmark = session.createDataFrame([(*r, 1) for r in items], "item_id long, text string, n_words int")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(decontaminate.decontaminate(odd, benchmark)) == brute_force(docs, items)
    assert result(decontaminate.decontaminate(nothing, benchmark)) == []
    clean = decontaminate.decontaminate(odd, benchmark.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated for r in clean)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
