from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from pressroom.llm import charnet, queries, secrets

PATTERNS = [
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
]


def brute_force(text):
    found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, pattern, ok) in enumerate(PATTERNS) for m in re.finditer(pattern, text or "") if ok(m)]
    return [x for _, _, x in sorted(found)]


def secret_texts(n, seed=1):
    draw = random.Random(seed)
    some = lambda letters, k: "".join(draw.choice(letters) for _ in range(k))
    letters, hexes = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef"
    out = []
    for i in range(n):
        words = [some("aeiounrst", draw.randrange(2, 9)) for _ in range(30)]
        words += [f"http://x.org/{some('abc', 6)}-{some('abc', 6)}-2024-05-01", f"order-{i:08d}-item-number"]
        if i % 3 == 0:
            words[draw.randrange(30)] = draw.choice([f'token = "{some(hexes, 40)}"', f"PASSWORD: {some(letters, 24)}", f"AKIA{some('ABCDEFGHIJ0123456789', 16)}"])
        out.append(" ".join(words))
    return out


def test_patterns_equal_brute_force():
    texts = [
        "token: password: secretsecret", "Password='short' passwd=longenough1 é api_key=\"abc.def-ghi_1\"", "AKIA123 AKIAAKIAAKIAAKIA",
        "0" * 31 + "g" + "0" * 32, "ſecret=12345678 toKen=12345678 SECRET=12345678", "", "token=" + "a" * 50_000, "漢字 token=abcdef0123456789abcdef0123456789ab",
    ]
    for text in [*texts, *secret_texts(60)]:
        got = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in secrets.base_findings(text)]
        assert got == brute_force(text)


def test_network_learns_and_keeps_recall():
    draw = np.random.default_rng(0)
    texts = [("token = " + "".join(draw.choice(list("0123456789abcdef"), 40)), 8, 48, 1) for _ in range(150)]
    texts += [("see the " + "-".join(["some", "ordinary", "words", "2024"]) + " now", 8, 34, 0) for _ in range(150)]
    x = np.stack([charnet.window(t, a, b) for t, a, b, _ in texts])
    y = np.array([label for *_, label in texts])
    net = charnet.CharNet.fresh()
    net.fit(x[::2], y[::2])
    net.calibrate(x[1::2], y[1::2], 0.95)
    p = net.probability(x[1::2])
    assert np.mean(p[y[1::2] == 1] >= net.threshold) >= 0.95 and np.mean(p[y[1::2] == 0] >= net.threshold) == 0
    assert p.min() >= 0 and p.max() <= 1


def test_query_over_planted_secrets(session, tmp_path):
    texts = secret_texts(300)
    unknown = "value zq 9f86d081884c7d65Zq19f86d081884c7d65Ab end"  # no pattern has it
    rows = [(i, t) for i, t in enumerate([*texts, unknown, None, ""])]
    session.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op3_secrets"](session, str(tmp_path)).collect()}
    for i, text in rows:
        base = brute_force(text)
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")]
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = [x for x in got[i].spans.split(",") if x]
        assert set(base) <= set(spans) and [x for x in spans if not x.startswith("learned")] == base
    clean = [i for i in range(300) if i % 3]
    assert sum("learned" in got[i].spans for i in clean) <= 0.02 * len(clean)


def test_redaction_keeps_everything_else(session, odd):
    rows = [(i, t, i * 2) for i, t in enumerate(secret_texts(120))]
    docs = session.createDataFrame(rows, "doc_id long, text string, other long")
    got = {r.doc_id: r for r in secrets.redact(docs).collect()}
    for i, text, other in rows:
        assert got[i].other == other and (got[i].text == text) == (not brute_force(text) and "[learned]" not in got[i].text)
        assert not brute_force(got[i].text)
    assert sorted(map(repr, secrets.redact(odd).collect())) == sorted(map(repr, odd.collect()))


def test_odd_rows(odd, nothing):
    assert secrets.secret_spans(odd).count() == odd.count()
    assert secrets.secret_spans(nothing).count() == 0
    overlapping = [(0, 0, 10), (5, 2, 20), (20, 1, 30)]
    assert secrets._redacted("x" * 40, overlapping) == "[assign]" + "[access]" + "x" * 10
