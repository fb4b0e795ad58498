from __future__ import annotations

import itertools
import re

from pyspark.sql import functions as F

from pressroom.llm import queries, urls


def brute_force(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(h + p, v) for h, p, v in urls.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, rule, verdict


URLS = [
    "https://WWW.Example.org/es/1?q", "http://a.example.org/en/12#x", "http://example.com/de/", "http://x.com/fr/1", "http://x.com/de", "ftp://org/", "http://org",
    "no scheme", "", None, "http://sub.org?x=/es/", "x://y://example.org/es/", "http://fexample.org/es/1", "http://exämple.ORG/é", "://com/de/x", "http://a.com\n/de/1",
    "http://example.org/en/1", "http://example.net/en/1",
]


def test_listed_rules(session, no_labels):
    pages = session.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(0, URLS[0], "x"), (None, None, None)], "page_id long, url string, html string")
    got = urls.judge(pages, no_labels).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = brute_force(URLS[r.page_id] if r.page_id is not None else None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
    assert urls.judge(pages.limit(0), no_labels).count() == 0


def test_listed_verdicts_are_the_contract(session, no_labels):
    """Each rule's word, stated here and not read from the operator."""
    wanted = {
        "http://example.org/en/1": ("example.org/en/1", "block"), "http://www.example.org/en/12?q": ("example.org/en/1", "block"), "http://example.org/en/2": ("org/", "allow"),
        "http://example.org/es/1": ("example.org/es/", "block"), "http://a.org/en/1": ("org/", "allow"), "http://a.com/fr/1": ("com/fr/", "allow"), "http://a.com/de/1": ("com/de/", "block"),
    }
    pages = session.createDataFrame([(i, u) for i, u in enumerate(wanted)], "page_id long, url string")
    assert {(r.page_id, r.rule, r.verdict) for r in urls.judge(pages, no_labels).collect()} == {(i, *said) for i, said in enumerate(wanted.values())}


def test_mined_rules_match_all_their_tokens(session, tmp_path):
    pages, marks = [], []
    for i in range(600):
        bad = i % 4 == 0
        pages.append((i, f"http://{'ads' if bad or i % 3 == 0 else 'www'}.site{i % 7}.net/{'track' if bad else 'read'}/{i}", ""))
        marks.append((i, 1, int(bad)))
    pages.append((600, "http://ads.new.net/track/x", ""))
    pages.append((601, "http://ads.new.net/read/x", ""))
    session.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    session.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.page_id: r for r in queries.QUERIES["op1_url_filter"](session, str(tmp_path)).collect()}
    assert all((got[i].verdict == "block") == (i % 4 == 0) for i in range(600))
    assert got[600].verdict == "block" and "path:track" in got[600].mined and got[601].verdict == "allow"
    url = F.col("url")
    parts = session.createDataFrame(pages, "page_id long, url string, html string").withColumn("tokens", urls.tokens(url, urls.host(url), urls.path(url)))
    rules = urls.mine(parts, session.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert rules and all(c >= urls.LEAST_CONFIDENCE for c, t in rules)


def marked_pages(session, urls_and_marks):
    url = F.col("url")
    pages = session.createDataFrame([(i, u) for i, (u, _) in enumerate(urls_and_marks)], "page_id long, url string")
    labels = session.createDataFrame([(i, 1, m) for i, (_, m) in enumerate(urls_and_marks)], "doc_id long, quality int, toxic int")
    return pages.withColumn("tokens", urls.tokens(url, urls.host(url), urls.path(url))), labels


def test_a_long_shared_path_is_one_rule_of_all_its_tokens(session):
    shared = "/".join(f"part{k}" for k in range(40))
    pages, labels = marked_pages(session, [(f"http://a{i}.b{i}/{shared if i % 50 == 0 else f'own{i}/x{i}'}/{i}", int(i % 50 == 0)) for i in range(600)])
    rules = urls.mine(pages, labels)
    assert [t for _, t in rules] == [tuple(sorted(f"path:part{k}" for k in range(40)))]


def test_mined_rules_equal_brute_force(session):
    """Every set of tokens, of any size, on its closure: the tokens that all labelled pages with the set have in the same rows as one of its own."""
    rows = []
    for i in range(400):
        parts = [name for name, n in (("a", 2), ("b", 3), ("c", 5), ("d", 7)) if i % n == 0]
        rows.append((f"http://h/{'/'.join(parts)}{'/e/f' if i % 5 == 0 else ''}", int(i % 210 % 30 == 0 or i % 11 == 0)))
    pages, labels = marked_pages(session, rows)
    sets = [(set(r.tokens), rows[r.page_id][1]) for r in pages.collect()]
    where = {t: frozenset(k for k, (s, _) in enumerate(sets) if t in s) for t in set().union(*(s for s, _ in sets))}
    wanted = {}
    for n in range(1, len(where) + 1):
        for some in itertools.combinations(sorted(where), n):
            rule = tuple(sorted(t for t in where if where[t] in {where[x] for x in some}))
            there = frozenset.intersection(*(where[t] for t in rule))
            both = sum(sets[k][1] for k in there)
            if both >= urls.LEAST_SUPPORT * len(sets):
                share, z, m = both / len(there), 1.96, len(there)
                low = (share + z * z / (2 * m) - z * (share * (1 - share) / m + z * z / (4 * m * m)) ** 0.5) / (1 + z * z / m)
                if low >= 0.3:
                    wanted[rule] = low
    kept = []
    for low, _, rule in sorted((-low, len(rule), rule) for rule, low in wanted.items()):
        if not any(set(other) <= set(rule) for other in kept):
            kept.append(rule)
    assert kept and max(map(len, kept)) > 3
    assert [t for _, t in urls.mine(pages, labels, confidence=0.3)] == kept


def test_odd_pages(session, odd_labels):
    """Names that the operator uses itself, very long urls, urls of very many tokens, equal and null ids."""
    rows = [(i, u, "mine", "r", 1, "t") for i, u in enumerate(["http://h/" + "x" * 200_000, "http://h/" + "/".join(map(str, range(20_000))), None, "http://h/a?" + "&".join(f"k{i}=1" for i in range(5000))])]
    rows += [rows[0], (None, "http://h/de", None, None, None, None)]
    pages = session.createDataFrame(rows, "page_id long, url string, host string, rule string, row long, tokens string")
    got = urls.judge(pages, odd_labels)
    assert got.count() == len(rows) and got.columns == ["page_id", "host", "path", "rule", "verdict", "mined"]
    assert urls.judge(pages.limit(0), odd_labels).count() == 0
