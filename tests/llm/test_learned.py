"""Quality ranking, quality rules, toxicity: planted signals, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pressroom.llm import features, labels, quality, queries, rules, toxicity

INSULTS = ["zornik", "mulpat", "grobtel"]


def corpus(n=900, seed=5):
    """Clean texts, junk (labelled 0), and toxic texts with one of three insults, some of them with an ending of their own."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abdeghilmnoprstu") for _ in range(draw.randrange(2, 9))) for _ in range(500)]
    docs, marks = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(20, 120))]
        junk, toxic = i % 6 == 0, i % 5 == 1
        if junk:
            text = [w + draw.choice(["###", "&&&", "%%%"]) for w in text] if i % 12 else [w.upper() + "!!" for w in text]
        if toxic:
            for _ in range(3):
                text.insert(draw.randrange(len(text)), draw.choice(INSULTS) + draw.choice(["", "en", "ig", "er"]))
        docs.append((i, " ".join(text), "en", "s", 1))
        if i % 10 != 3:
            marks.append((i, int(not junk), int(toxic)))
    return docs, marks


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    docs, marks = corpus()
    root = tmp_path_factory.mktemp("learned")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), docs, {i: (q, t) for i, q, t in marks}


def test_fold_is_the_crc_of_the_id_as_text(session):
    got = session.range(50).select("id", labels.fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_quality_on_held_out_rows(session, tables):
    root, docs, marks = tables
    got = {r.doc_id: r for r in queries.QUERIES["op2_quality"](session, root).collect()}
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [i for i, r in got.items() if r.held_out]
    assert np.mean([got[i].predicted == int(i % 6 != 0) for i in held]) > 0.98


def test_scores_don_t_depend_on_anything_but_the_text(session, tables):
    root, _, _ = tables
    docs, marks = session.read.parquet(f"{root}/documents.parquet"), session.read.parquet(f"{root}/labels.parquet")
    one = {r.doc_id: r.score for r in quality.quality_scores(docs, marks).collect()}
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source").repartition(3)
    assert {r.doc_id: r.score for r in quality.quality_scores(other, marks).collect()} == pytest.approx(one)


def test_pairs_rank_by_the_feature_that_matters():
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(600, len(features.NAMES)))
    y = (x[:, 3] - 0.5 * x[:, 7] > 0).astype(int)
    model = quality.fit(x, y)
    assert np.mean((model.score(x) >= quality.CUT) == (y == 1)) > 0.97
    assert abs(model.weights[3] / model.weights[7] + 2) < 0.5
    flat = quality.fit(x, np.ones(600, int))
    assert np.all(flat.score(x) >= quality.CUT)


def test_toxicity_on_held_out_rows(session, tables):
    root, docs, marks = tables
    got = {r.doc_id: r for r in queries.QUERIES["op9_toxicity"](session, root).collect()}
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [i for i, r in got.items() if r.held_out]
    assert np.mean([got[i].predicted == int(i % 5 == 1) for i in held]) > 0.97


def test_hidden_spellings():
    assert toxicity.unhidden("z0rn1k") == "zornik" and toxicity.unhidden("z*o*r*n*i*k") == "zornik" and toxicity.unhidden("zooorniiik") == "zornik"
    column = pa.array(["a z0rn1k here", "plain words", None, "ab-cd", "x1"])
    cut = toxicity.words.words(column, toxicity.words.SPACED)
    found = [cut.data[cut.starts[w] : cut.ends[w]].tobytes().decode() for w in toxicity.odd_words(cut)]
    assert found == ["z0rn1k", "ab-cd"]


def test_exact_binomial():
    for n, k, risk in ((50, 0, 0.1), (200, 3, 0.05), (30, 5, 0.3), (10, 10, 0.5)):
        tail = sum(math.comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1))
        assert rules.below(k, n, risk, tail * 1.001) and not rules.below(k, n, risk, tail * 0.999)
    assert not rules.below(0, 0, 0.01, 0.05)


def test_rules_against_brute_force(session, tables):
    root, docs, marks = tables
    got = {r.doc_id: r for r in queries.QUERIES["op6_quality_rules"](session, root).collect()}
    for i, text, *_ in docs:
        words = text.split()
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text))
        windows = [tuple(words[j : j + 5]) for j in range(len(words) - 4)]
        covered = {j + k for j, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
        assert r.n_repeat_words == len(covered)
        worded = [line for line in text.split("\n") if line.split()]
        assert r.n_dup_lines == sum(line in worded[:k] for k, line in enumerate(worded))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r.base_failed and r.kept)


def test_risk_is_kept(session, tables):
    root, docs, marks = tables
    docs, label_rows = session.read.parquet(f"{root}/documents.parquet"), session.read.parquet(f"{root}/labels.parquet")
    judged = {r.doc_id: r for r in rules.quality_rules(docs, label_rows, risk=0.2).collect()}
    good = [i for i in judged if i % 6 and not judged[i].base_failed]
    assert np.mean([judged[i].kept for i in good]) >= 0.8
    assert np.mean([judged[i].kept for i in judged if i % 12 == 6]) < 0.1  # symbols after every word
    none = rules.quality_rules(docs, label_rows.limit(5)).filter("NOT kept AND NOT base_failed")
    assert none.count() == 0


def test_kept_against_brute_force(session, tables):
    """The path and the tests along it, text by text, in plain loops."""
    root, docs, marks = tables
    frames = session.read.parquet(f"{root}/documents.parquet"), session.read.parquet(f"{root}/labels.parquet")
    got = {r.doc_id: r for r in rules.quality_rules(*frames, risk=0.2).collect()}
    half = {r[0]: r[1] for r in session.range(max(got) + 1).selectExpr("id", "pmod(xxhash64(id, 'half'), 2)").collect()}
    label = {r.doc_id: r.quality for r in frames[1].collect()}
    values = {}
    for i, text, *_ in docs:
        r, n = got[i], max(1, len(text.split()))
        chars = len("".join(text.split()))
        values[i] = [r.n_symbols / max(chars, 1), r.n_dup_lines / max(1, sum(bool(x.split()) for x in text.split("\n"))), r.n_repeat_words / n, chars / n, -chars / n]
    names, used = list(rules.GRID), {}
    for s in range(3):
        mine = [i for i in values if not got[i].base_failed and label.get(i) is not None and sum(got[i].n_words >= b for b in rules.STRATA) == s]
        sides = [[i for i in mine if half[i] == h] for h in (0, 1)]
        if not all(sides):
            continue
        hit = lambda i, cuts: any(v > c for v, c in zip(values[i], cuts, strict=True))
        union, path = [math.inf] * 5, []
        while sum(hit(i, union) for i in sides[0] if label[i]) <= 0.4 * sum(label[i] for i in sides[0]):
            steps = []
            for k, name in enumerate(names):
                for c in (c for c in rules.GRID[name] if c < union[k]):
                    new = [i for i in sides[0] if values[i][k] > c and not hit(i, union)]
                    steps.append((sum(not label[i] for i in new) / (1 + sum(label[i] for i in new)), k, c))
            best = max((g for g, *_ in steps), default=0)
            if not best:
                break
            _, k, c = next(x for x in steps if x[0] == best)
            union = [*union[:k], c, *union[k + 1 :]]
            path.append(union)
        used[s] = [math.inf] * 5
        for union in path:
            n, k = sum(label[i] for i in sides[1]), sum(hit(i, union) for i in sides[1] if label[i])
            if sum(math.comb(n, j) * 0.2**j * 0.8 ** (n - j) for j in range(k + 1)) > rules.DELTA / 3:
                break
            used[s] = union
    assert any(c < math.inf for cuts in used.values() for c in cuts)
    for i, r in got.items():
        cuts = used.get(sum(r.n_words >= b for b in rules.STRATA), [math.inf] * 5)
        assert r.kept == (not r.base_failed and not any(v > c for v, c in zip(values[i], cuts, strict=True)))


def test_risk_is_exceeded_in_few_draws_of_labels():
    """Texts whose good and bad ones differ little, so that many unions lie near the risk: of 600 draws of labels, no more than DELTA say lead to rules that reject
    more than the risk of the good texts of a stratum."""
    random = np.random.default_rng(8)
    ways = random.integers(0, 4, (30, 5)) * (random.random((30, 5)) < 0.15)
    shares = [(random.dirichlet(np.full(30, 0.5)), random.dirichlet(np.full(30, 0.5))) for _ in range(3)]
    risk, exceeded, used = 0.15, 0, 0
    for _ in range(600):
        halves = {
            (s, h): rules.Marked(ways, random.multinomial(150, good), random.multinomial(150, bad)) for s, (good, bad) in enumerate(shares) for h in (0, 1)
        }
        cutoffs = rules.chosen(halves, risk)
        over = False
        for s, (good, _) in enumerate(shares):
            union = tuple(len(g) - 1 - g.index(cutoffs[s, rule]) if (s, rule) in cutoffs else len(g) for rule, g in rules.GRID.items())
            over = over or good[halves[s, 0].rejected(union)].sum() > risk
        exceeded, used = exceeded + over, used + bool(cutoffs)
    assert used > 300
    assert exceeded <= 600 * rules.DELTA + 2 * math.sqrt(600 * rules.DELTA)


def test_a_training_sample_has_one_row_for_each_id(session):
    docs = session.createDataFrame([(1, f"copy {k}") for k in range(500)] + [(2, None), (2, None), (3, "three"), (None, "x")], "doc_id long, text string")
    marks = session.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (4, 1), (None, 1)], "doc_id long, quality int")
    sample = labels.training_sample(docs, marks, "quality", 1, 1)
    got = {r.doc_id: (r.text, r.label) for r in sample.collect()}
    assert sample.count() == 3 and got[2] == (None, 0) and got[3] == ("three", 1)
    text, label = got[1]
    assert label == 1 and text.startswith("copy ")
    assert {r.doc_id: (r.text, r.label) for r in labels.training_sample(docs.repartition(7), marks, "quality", 1, 1).collect()} == got
    assert labels.training_sample(docs, marks, "quality", 1, 1, rows=2).count() == 2


@pytest.mark.parametrize("which", [quality.quality_scores, toxicity.toxicity_scores, rules.quality_rules])
def test_odd_rows(odd, nothing, odd_labels, no_labels, which):
    for label_rows in (odd_labels, no_labels):
        assert which(odd, label_rows).count() == odd.count()
        assert which(nothing, label_rows).count() == 0
    if which is not rules.quality_rules:
        assert which(odd, odd_labels).filter("score IS NULL OR isnan(score) OR score < 0 OR score > 1 OR held_out IS NULL").count() == 0


def test_keeping_good_rows_keeps_columns(odd, no_labels):
    assert quality.keep_good(odd, no_labels).schema == odd.schema
    assert quality.keep_good(odd, no_labels).count() == odd.count()  # nothing learned, nothing rejected
