"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words, and beginnings of words of a few lengths, that labelled toxic texts have and others don't. The features are how densely a text
uses them, how close to a second person, and rates of capitals, punctuation and obfuscated spelling. Trees and calibration are Spark's own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import features, labels, words
from pressroom.session import settle

FOLDS, HELD_OUT = 3, 1
CUT = 0.7
#: Lengths of word beginnings in bytes; 0 is the whole word. A term needs so many toxic texts, and this lower bound of their share.
BEGINNINGS = (0, 4, 5, 6, 7)
LEAST_TEXTS, LEAST_SHARE = 6, 0.6
#: Words between a term and a second person that still count as near.
NEAR = 5
TREES, DEPTH = 20, 3

#: Words for the second person in the languages of the corpus.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deiner deinen ihr euch euer sie ihnen tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro su"
).split()
#: Digits and signs that stand for letters.
LEET = str.maketrans("013457@$!|", "oieastasil")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "0123456789@$!|*._-"]] = True

NAMES = [
    "log_words",
    *(f"density_{k}" for k in BEGINNINGS),
    *(f"count_{k}" for k in BEGINNINGS),
    "distinct_hits",
    "plain_or_hidden",
    "second_person",
    "near_second_person",
    "capital_rate",
    "shouted_words",
    "exclaim_rate",
    "stop_rate",
    "symbol_rate",
    "odd_spelling",
    "hidden_hits",
    "stretched",
    "single_letters",
]


def _terms(cut: words.Words) -> dict[int, np.ndarray]:
    """The hash of each word and of its beginnings; a word that is not longer than a beginning has 0 there."""
    out = {}
    for k in BEGINNINGS:
        if k:
            part = words.Words(cut.data, cut.starts, np.minimum(cut.ends, cut.starts + k), cut.first)
            out[k] = np.where(cut.ends - cut.starts > k, part.hashes() ^ np.uint64(k), np.uint64(0))
        else:
            out[k] = cut.hashes()
    return out


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def unhidden(word: str) -> str:
    """A word with digits and signs read as letters, inner signs left out and stretched letters shortened."""
    plain = re.sub(r"[^a-z]+", "", word.lower().translate(LEET))
    return re.sub(r"(.)\1{2,}", r"\1", plain)


def odd_words(cut: words.Words) -> np.ndarray:
    """The words with a digit or sign between two letters."""
    data = cut.data
    if len(data) < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(_LETTER[data[:-2]] & _ODD[data[1:-1]] & (_LETTER[data[2:]] | _ODD[data[2:]])) + 1
    word = np.searchsorted(cut.starts, at, side="right") - 1
    ok = (word >= 0) & (at + 1 < cut.ends[np.maximum(word, 0)])
    return np.unique(word[ok])


def stretched_words(cut: words.Words) -> np.ndarray:
    """Whether each word has a letter three times in a row."""
    data = cut.data
    if len(data) < 3:
        return np.zeros(len(cut.starts), bool)
    triple = np.concatenate([[0], np.cumsum(_LETTER[data[:-2]] & (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:])), [0, 0]])
    triple[-2:] = triple[-3]
    return triple[np.maximum(cut.ends - 2, cut.starts)] > triple[cut.starts]


def dense(column: pa.Array, lexicon: dict[int, np.ndarray]) -> np.ndarray:
    """One row of features for each text, as ``NAMES`` lists them."""
    cut = words.words(column, words.ALPHANUMERIC, lower=True)
    spaced = words.words(column, words.SPACED)
    data, offsets = words.text_bytes(column)
    some = np.maximum(cut.counts, 1)
    terms = _terms(cut)
    hits = {k: _is_in(terms[k], lexicon[k]) for k in BEGINNINGS}
    any_hit = np.logical_or.reduce(list(hits.values()))
    second = _is_in(terms[0], _SECOND)
    # second persons among the words around each hit, within the same text
    reached = np.concatenate([[0], np.cumsum(second)])
    at = np.flatnonzero(any_hit)
    owner = np.searchsorted(cut.first, at, side="right") - 1
    around = reached[np.minimum(at + NEAR + 1, cut.first[owner + 1])] - reached[np.maximum(at - NEAR, cut.first[owner])]
    near = np.bincount(owner[around > 0], minlength=len(some))
    distinct = np.diff(words.distinct_by_owner(np.searchsorted(at, cut.first), terms[0][at])[1])

    odd = odd_words(spaced)
    hidden = np.zeros(len(some), np.int64)
    odd_owner = np.searchsorted(spaced.first, odd, side="right") - 1
    if len(odd):
        plain = [unhidden(spaced.data[spaced.starts[w] : spaced.ends[w]].tobytes().decode("utf-8", "replace")) for w in odd]
        one = words.words(pa.array(plain, pa.string()), words.ALPHANUMERIC)
        there = _terms(one)
        found = np.logical_or.reduce([_is_in(there[k], lexicon[k]) for k in BEGINNINGS])
        hidden = np.bincount(odd_owner[features.sums(found, one.first) > 0], minlength=len(some))
    classes = features.byte_classes(data, offsets)
    rates = classes / np.maximum(np.diff(offsets), 1)[:, None]
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    shouted = upper[spaced.ends] - upper[spaced.starts] > 2
    single = (cut.ends - cut.starts == 1) & _LETTER[cut.data[cut.starts]] if len(cut.starts) else np.zeros(0, bool)
    row = single.copy()
    row[1:] &= single[:-1]
    counts = {k: features.sums(hits[k], cut.first) for k in BEGINNINGS}
    return np.column_stack(
        [
            np.log1p(cut.counts),
            *(counts[k] / some for k in BEGINNINGS),
            *(counts[k] for k in BEGINNINGS),
            distinct,
            features.sums(any_hit, cut.first) + hidden,
            features.sums(second, cut.first) / some,
            near / some,
            rates[:, 0],
            features.sums(shouted, spaced.first) / np.maximum(spaced.counts, 1),
            rates[:, 4],
            rates[:, 5],
            rates[:, 3],
            np.bincount(odd_owner, minlength=len(some)) / some,
            hidden,
            features.sums(stretched_words(cut), cut.first) / some,
            features.sums(row, cut.first) / some,
        ]
    ).astype(np.float64)


_SECOND = np.sort(words.words(pa.array([" ".join(SECOND_PERSON)]), words.ALPHANUMERIC, lower=True).hashes())


def _text_terms(known: dict[int, np.ndarray] | None):
    """Partial counts of texts that have a term, of all terms or of known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            cut = words.words(piece.column(0), words.ALPHANUMERIC, lower=True)
            for k, values in _terms(cut).items():
                keep = values != 0 if known is None else _is_in(values, known[k])
                first = np.concatenate([[0], np.cumsum(keep)])[cut.first]
                each, _ = words.distinct_by_owner(first, values[keep])
                term, n = np.unique(each, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(term), k)), pa.array(term.view(np.int64)), pa.array(n)], ["kind", "term", "n"])

    return run


def _by_kind(counts: DataFrame, least: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    rows = counts.groupBy("kind", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).toArrow()
    kind, term, n = (rows.column(c).to_numpy() for c in ("kind", "term", "n"))
    out = {}
    for k in BEGINNINGS:
        mine = term[kind == k].astype(np.int64).view(np.uint64)
        order = np.argsort(mine)
        out[k] = mine[order], n[kind == k][order]
    return out


def learn_lexicon(sample: DataFrame) -> dict[int, np.ndarray]:
    """Terms of ``sample (text, label)`` that toxic texts have; the sample is bounded, and so is what reaches the driver."""
    schema = "kind long, term long, n long"
    toxic = _by_kind(sample.filter("label = 1").select("text").mapInArrow(_text_terms(None), schema), LEAST_TEXTS)
    asked = {k: terms for k, (terms, _) in toxic.items()}
    clean = _by_kind(sample.filter("label = 0").select("text").mapInArrow(_text_terms(asked), schema), 1)
    out = {}
    for k, (terms, n) in toxic.items():
        others = np.zeros(len(terms))
        there, m = clean[k]
        others[np.searchsorted(terms, there)] = m
        total = n + others
        share, z = n / np.maximum(total, 1), 1.96
        lower = (share + z * z / (2 * total) - z * np.sqrt(share * (1 - share) / total + z * z / (4 * total**2))) / (1 + z * z / total)
        out[k] = terms[lower >= LEAST_SHARE]
    return out


def _rows(lexicon: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            x = dense(piece.column(piece.schema.get_field_index("text")), lexicon)
            lists = words.list_array(x.ravel(), np.arange(len(x) + 1) * x.shape[1], pa.float64())
            kept = [c for c in piece.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), lists], [*kept, "x"])

    return run


def toxicity_scores(docs: DataFrame, label_rows: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` and ``label_rows (doc_id, toxic)`` to ``(doc_id, held_out, score, predicted)``, one row for each
    row of ``docs``.

    Null and empty texts have the features of a text without words and a score like any other. Without labels of both kinds, every
    score is 0. Ids without labels, repeated ids and null ids are scored too; other columns are ignored; an empty table gives no rows.
    """
    sample = settle(labels.training_sample(docs, label_rows, "toxic", FOLDS, HELD_OUT))
    seen = {row["label"] for row in sample.select("label").distinct().collect()}
    out = labels.held_out(FOLDS, HELD_OUT).alias("held_out")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    if seen != {0, 1}:
        return docs.select("doc_id", out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    lexicon = learn_lexicon(sample)
    rows = settle(
        sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(3)))
        .select("part", "label", "text")
        .mapInArrow(_rows(lexicon), "part long, label int, x array<double>")
    )
    vectors = lambda df: df.withColumn("features", array_to_vector("x"))
    fitted = vectors(rows.filter("part > 0")).select("features", F.col("label").cast("double").alias("label"))
    if fitted.select("label").distinct().count() < 2:  # all of one kind in this part: use the whole sample
        fitted = vectors(rows).select("features", F.col("label").cast("double").alias("label"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, cacheNodeIds=False).fit(fitted.coalesce(4))
    probability = lambda df: trees.transform(vectors(df)).withColumn("p", vector_to_array("probability")[1])
    kept = probability(rows.filter("part = 0")).select(F.col("p"), F.col("label").cast("double").alias("label"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="score").fit(
        kept if kept.head(1) else probability(rows).select("p", F.col("label").cast("double").alias("label"))
    )
    scored = calibration.transform(probability(docs.mapInArrow(_rows(lexicon), "doc_id long, x array<double>")))
    score = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", out, score.alias("score"), (score >= CUT).cast("int").alias("predicted"))
