from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressroom.llm import lm, queries, recurrent


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def chained(n, seed=2):
    """Texts of two kinds whose words say much about the next word."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        letters = "abcdefgh" if i % 2 else "stuvwxyz"
        k = draw.randrange(8)
        text = []
        for _ in range(draw.randrange(5, 40)):
            k = (k + draw.choice([1, 1, 1, 2])) % 8
            text.append(letters[k].upper() if draw.random() < 0.1 else letters[k])
        if draw.random() < 0.3:
            text.insert(draw.randrange(len(text)), f"rare{draw.randrange(60)}")
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    rows = list(enumerate(chained(1200)))
    root = tmp_path_factory.mktemp("lm")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lm, "FREQUENT", 30)  # most rare words meet their counts in the join
        patch.setattr(lm, "VOCABULARY", 20)
        patch.setattr(lm, "SHARE", 2)
        return rows, {r.doc_id: r for r in queries.QUERIES["op8_lm_scores"](spark, str(root)).collect()}


def test_base_scores_equal_brute_force(scored):
    rows, got = scored
    learned = [t for i, text in rows if zlib.crc32(str(i).encode()) % 7 != 2 for t in tokens(text)]
    counts = collections.Counter(learned)
    for i, text in rows:
        own, r = tokens(text), got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), len(learned))
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (len(learned) + len(counts) + 1)) for t in own), abs=1e-6)


def test_network_beats_single_words_on_held_out_texts(scored):
    _, got = scored
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_every_training_document_trains_the_network(session):
    docs = session.createDataFrame(list(enumerate(chained(40))), "doc_id long, text string").coalesce(1)
    counts = lm.Counts.of(lm.word_counts(docs.select("text")))
    whole = lm.train(docs, counts).flat()
    for left_out in (0, 7, 13, 22, 31, 39):
        assert not np.array_equal(whole, lm.train(docs.filter(f"doc_id <> {left_out}"), counts).flat())


def test_the_network_knows_the_words_that_make_up_most_of_the_corpus(session):
    rows = [(w, n) for w, n in enumerate([40] * 3000 + [1] * 20_000)]
    counts = lm.Counts.of(session.createDataFrame(rows, "word long, n long"))
    assert int((counts.number != counts.other).sum()) == 0.75 * (120_000 + 20_000) // 40 + (0.75 * 140_000 % 40 > 0)
    assert len(set(counts.word_class)) > 24


def test_probabilities_of_all_words_add_up_to_one():
    counts = np.array([500, 300, 200, 90, 50, 20, 10, 5, 2, 1])
    word_class = np.unique(recurrent.classes(counts, 4), return_inverse=True)[1]
    model = recurrent.Model.fresh(word_class, counts)
    states = np.random.default_rng(3).normal(size=(7, recurrent.HIDDEN)).astype(np.float32)
    total = sum(np.exp(recurrent.log_probabilities(model, states, np.full(7, w))) for w in range(10))
    assert total == pytest.approx(np.ones(7), abs=1e-5)


def test_scores_don_t_depend_on_windows_slots_or_neighbours():
    random_ = np.random.default_rng(4)
    word_class = np.array([0, 1, 1, 2, 2, 2])
    model = recurrent.Model.fresh(word_class, np.array([60, 30, 20, 10, 5, 2]))
    model.weights = {k: v + random_.normal(size=v.shape).astype(np.float32) * 0.3 for k, v in model.weights.items()}
    lengths = [5, 1, 0, 70, 12, 33, 1]
    first = np.concatenate([[0], np.cumsum(lengths)])
    ids = random_.integers(0, 6, first[-1]).astype(np.int32)
    whole = recurrent.score(model, ids, first)
    for slots, window in ((1, 4), (3, 7), (100, 1000)):
        assert recurrent.score(model, ids, first, slots, window) == pytest.approx(whole, rel=1e-4)
    alone = [recurrent.score(model, ids[a:b], np.array([0, b - a]))[0] for a, b in zip(first, first[1:], strict=False)]
    assert whole == pytest.approx(alone, rel=1e-4)


def test_gradients_equal_differences():
    random_ = np.random.default_rng(5)
    word_class = np.array([0, 0, 1, 1, 1])
    model = recurrent.Model.fresh(word_class, np.array([9, 7, 5, 3, 1]))
    model.weights = {k: (v + random_.normal(size=v.shape) * 0.5) for k, v in model.weights.items()}  # double precision
    before, token = random_.integers(0, 6, (6, 3)), random_.integers(0, 5, (6, 3))
    trainer = recurrent.Trainer(model)
    kept = {}
    trainer._update = kept.update
    trainer._step(before, token, np.zeros((3, recurrent.HIDDEN)))

    def loss(weights):
        other = recurrent.Trainer(recurrent.Model(model.edges, weights))
        other._update = lambda g: None
        states = []
        h = np.zeros((3, recurrent.HIDDEN))
        table = weights["embedding"] @ weights["input"] + weights["bias"]
        n = recurrent.HIDDEN
        for t in range(6):
            h = h * (before[t] != 5)[:, None]
            x, u = table[before[t]], h @ weights["recurrent"]
            r, z = recurrent.sigmoid(x[:, :n] + u[:, :n]), recurrent.sigmoid(x[:, n : 2 * n] + u[:, n : 2 * n])
            new = np.tanh(x[:, 2 * n :] + r * u[:, 2 * n :])
            h = new + z * (h - new)
            states.append(h)
        return -recurrent.log_probabilities(recurrent.Model(model.edges, weights), np.concatenate(states), token.reshape(-1)).mean()

    for name in ("embedding", "input", "bias", "recurrent", "class", "class_bias", "word", "word_bias"):
        w = model.weights[name]
        for _ in range(4):
            at = tuple(random_.integers(0, s) for s in w.shape)
            moved = []
            for step in (1e-5, -1e-5):
                weights = {k: v.copy() for k, v in model.weights.items()}
                weights[name][at] += step
                moved.append(loss(weights))
            assert kept[name][at] == pytest.approx((moved[0] - moved[1]) / 2e-5, abs=2e-5)


def test_outputs_of_nodes_with_few_and_many_rows_equal_plain_loops():
    random_ = np.random.default_rng(6)
    word_class = np.repeat(np.arange(9), [3, 4, 4, 3, 4, 1, 4, 4, 2])
    words, rows = len(word_class), 5000
    model = recurrent.Model.fresh(word_class, np.arange(words, 0, -1))
    model.weights = {k: v + random_.normal(size=v.shape) for k, v in model.weights.items()}  # double precision
    targets = np.minimum(random_.geometric(0.25, rows) - 1, words - 1)
    targets[:4] = words - 1
    sizes = np.bincount(word_class[targets])
    assert sizes.max() > recurrent.CACHED_ROWS and sizes.min() <= recurrent.FEW_ROWS[0] and ((sizes > recurrent.FEW_ROWS[0]) & (sizes <= recurrent.FEW_ROWS[-1])).any()
    states = random_.normal(size=(rows, recurrent.HIDDEN))
    w = model.weights
    gradient = {k: np.zeros_like(v) for k, v in w.items()}
    back, logs = np.zeros_like(states), np.zeros(rows)
    for i, (h, t) in enumerate(zip(states, targets, strict=True)):
        kind = word_class[t]
        group = model.class_group[kind]
        for name, first, last, at in (
            ("group", 0, len(model.group_edges) - 1, group),
            ("class", model.group_edges[group], model.group_edges[group + 1], kind),
            ("word", model.edges[kind], model.edges[kind + 1], t),
        ):
            logits = w[name][first:last] @ h + w[f"{name}_bias"][first:last]
            p = np.exp(logits - logits.max())
            p /= p.sum()
            logs[i] += np.log(p[at - first])
            p[at - first] -= 1
            gradient[name][first:last] += np.outer(p, h) / rows
            gradient[f"{name}_bias"][first:last] += p / rows
            back[i] += p @ w[name][first:last] / rows
    trainer = recurrent.Trainer(model)
    found, found_back = trainer._output(states, targets)
    assert recurrent.log_probabilities(model, states, targets) == pytest.approx(logs, rel=1e-9)
    assert found_back == pytest.approx(back, rel=1e-7, abs=1e-12)
    for name, g in found.items():
        assert g == pytest.approx(gradient[name], rel=1e-7, abs=1e-12)
    assert set(trainer.touched["word"]) == set(np.flatnonzero(np.isin(word_class, word_class[targets])))


def test_only_touched_rows_are_updated():
    model = recurrent.Model.fresh(np.repeat(np.arange(2000), 2), np.ones(4000))
    gradient = {k: np.ones_like(v) for k, v in model.weights.items()}
    every, gaps = np.arange(4000), np.setdiff1d(np.arange(4000), [0, 1, 777, 3999])
    for rows in (every, gaps, every[::3], np.array([5])):
        trainer = recurrent.Trainer(model)
        trainer.touched["word"] = rows
        trainer._update({k: v.copy() for k, v in gradient.items()})
        moved = np.flatnonzero((trainer.model.weights["word"] != model.weights["word"]).all(axis=1))
        assert np.array_equal(moved, rows) and np.array_equal(np.flatnonzero(trainer.v["word"].any(axis=1)), rows)
        assert (trainer.model.weights["class"] != model.weights["class"]).all()


def test_texts_are_cut_into_words_twice_at_most(session):
    read = session.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    docs = session.createDataFrame(list(enumerate(chained(70))), "doc_id long, text string").withColumn("text", seen("text"))
    assert len(lm.lm_scores(docs).collect()) == 70
    assert 70 < read.value <= 2 * 70


def test_written_numbers_are_those_of_the_words(session):
    docs = session.createDataFrame([(1, "a b a"), (2, None), (3, "c"), (4, "a new word")], "doc_id long, text string")
    counts = lm.Counts.of(lm.word_counts(docs.filter("doc_id < 4").select("text")))
    for row in lm.numbered(docs, counts).join(docs, "doc_id").collect():
        hashes, _ = lm._tokens(pa.array([row.text], pa.string()))
        n, ids = counts.look_up(hashes)
        assert (row.n_tokens, row.n_known) == (len(hashes), (n > 0).sum())
        assert np.array_equal(counts.numbers(pa.array([row.ids], pa.binary()))[0], ids)


def test_look_up_equals_a_search_of_all_words():
    random_ = np.random.default_rng(7)
    some = np.array([0, 2**64 - 1, *range(1 << 46, (1 << 46) + 9)], np.uint64)
    word = np.unique(np.append(random_.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2), some))
    at = np.arange(len(word))
    counts = lm.Counts(word, at + 1, 0, 0, at % 7, 7, np.zeros(8, int), np.ones(8))
    asked = np.concatenate([word, word + np.uint64(1), word - np.uint64(1), random_.integers(0, 2**63, 1000).astype(np.uint64)])
    place = {w: i for i, w in enumerate(word.tolist())}
    n, number = counts.look_up(asked)
    assert n.tolist() == [place.get(w, -1) + 1 for w in asked.tolist()]
    assert number.tolist() == [place[w] % 7 if w in place else 7 for w in asked.tolist()]


def test_odd_rows(odd, nothing):
    got = lm.lm_scores(odd).collect()
    assert len(got) == odd.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id == 0} == {1}
    assert lm.lm_scores(nothing).count() == 0
