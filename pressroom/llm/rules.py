"""Quality rules whose thresholds are set by risk control.

A rule rejects texts beyond a cutoff; the rules of a stratum (texts of similar length) reject together. The labelled texts are split in two by a hash of
their ids. The first half chooses a path: unions of rules that grow step by step, each step the cutoff that adds most bad texts for the good ones it costs. The other half is
the holdout: along the path it tests one union after the other, by an exact binomial test, whether fewer than RISK of the good texts are
rejected, and the last union before the first failure is used. The order was fixed without the holdout, so each test may use the whole level of its stratum, and the levels of the strata
add up to DELTA: with probability 1 - DELTA the rules reject at most RISK of the good texts of every stratum.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm import features, words
from pressroom.session import settle

RISK, DELTA = 0.02, 0.05
#: Texts of fewer words than this always fail, as do those with more than this percentage of repeated words.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: A stratum holds the texts with fewer words than its bound; the last one holds the rest.
STRATA = (200, 1000)
#: For each rule the measure and its cutoffs, from the loosest to the tightest; a text is rejected above the cutoff.
GRID = {
    "symbols": (0.5, 0.3, 0.2, 0.1, 0.05, 0.02, 0.01, 0.005),
    "duplicate_lines": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05),
    "repeated_words": (0.19, 0.17, 0.15, 0.12, 0.1, 0.07, 0.05, 0.02),
    "long_words": (40, 25, 18, 15, 12, 11, 10, 9),
    "short_words": (-1.5, -2, -2.5, -3, -3.5, -4, -4.5, -5),
}
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in words.pieces(batches, "text"):
        column = piece.column(1)
        cut = words.words(column, words.SPACED)
        data, offsets = words.text_bytes(column)
        n_lines, n_again = features.lines(column, cut.starts)
        counts = [
            cut.counts,
            features.code_points(data, offsets, words.SPACED),
            features.sums(_SYMBOL[data], offsets),
            n_again,
            features.repeated_words(cut.hashes(), cut.first),
            n_lines,
        ]
        yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(c, pa.int64()) for c in counts)], ["doc_id", *_COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` to the counts the rules use, one row each. Null has none."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def measures() -> dict[str, Column]:
    n = F.greatest("n_words", F.lit(1))
    return {
        "symbols": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "duplicate_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / n,
        "long_words": F.col("word_chars") / n,
        "short_words": -F.col("word_chars") / n,
    }


def stratum() -> Column:
    out = F.lit(len(STRATA))
    for k in reversed(range(len(STRATA))):
        out = F.when(F.col("n_words") < STRATA[k], k).otherwise(out)
    return out


def below(rejected: int, good: int, risk: float, level: float) -> bool:
    """The exact binomial test: with a risk of ``risk`` or more, at most ``rejected`` of ``good`` would occur with a chance of at most ``level``."""
    chance = 0.0
    for k in range(rejected + 1):
        if k > good:
            return False
        chance += math.exp(
            math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1) + k * math.log(risk) + (good - k) * math.log1p(-risk)
        )
        if chance > level:
            return False
    return True


@dataclass
class Marked:
    """Labelled texts of one stratum and half, grouped by how many cutoffs of each rule they exceed: good and bad ones of each group."""

    levels: np.ndarray
    good: np.ndarray
    bad: np.ndarray

    @classmethod
    def of(cls, levels: list[tuple[int, ...]], good: list[int], bad: list[int]) -> Marked:
        return cls(np.array(levels, np.int64).reshape(-1, len(GRID)), np.array(good, np.int64), np.array(bad, np.int64))

    def rejected(self, union: tuple[int, ...]) -> np.ndarray:
        """Groups that a union rejects: for each rule it says how many cutoffs, from the tightest on, a text may exceed at most."""
        return (self.levels > np.array(union)).any(axis=1)


NONE = tuple(len(grid) for grid in GRID.values())


def growing_unions(half: Marked, risk: float) -> list[tuple[int, ...]]:
    """The path through the unions. It ends where no cutoff adds a bad text, or well beyond the risk. Of equal steps the one with the first rule and the loosest cutoff is taken."""
    union, out = NONE, []
    while True:
        gone, best = half.rejected(union), None
        if half.good[gone].sum() > 2 * risk * half.good.sum():
            return out
        for rule in range(len(NONE)):
            for most in range(union[rule] - 1, -1, -1):
                new = (half.levels[:, rule] > most) & ~gone
                gain, cost = int(half.bad[new].sum()), int(half.good[new].sum())
                if gain and (best is None or gain / (cost + 1) > best[0]):
                    best = gain / (cost + 1), (*union[:rule], most, *union[rule + 1 :])
        if best is None:
            return out
        union = best[1]
        out.append(union)


def tested(path: list[tuple[int, ...]], half: Marked, risk: float, level: float) -> tuple[int, ...]:
    """The last union of the path before the first that fails its test on the holdout."""
    passed, good = NONE, int(half.good.sum())
    for union in path:
        if not below(int(half.good[half.rejected(union)].sum()), good, risk, level):
            break
        passed = union
    return passed


def chosen(halves: dict[tuple[int, int], Marked], risk: float = RISK, delta: float = DELTA) -> dict[tuple[int, str], float]:
    """From (stratum, half) to the cutoff of each (stratum, rule) that is used; half 1 is the holdout."""
    out: dict[tuple[int, str], float] = {}
    for s in range(len(STRATA) + 1):
        if (s, 0) in halves and (s, 1) in halves:
            union = tested(growing_unions(halves[s, 0], risk), halves[s, 1], risk, delta / (len(STRATA) + 1))
            out |= {(s, rule): grid[len(grid) - 1 - most] for (rule, grid), most in zip(GRID.items(), union) if most < len(grid)}
    return out


def thresholds(counts: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> dict[tuple[int, str], float]:
    """The cutoff of each (stratum, rule) that may be used. All labelled rows count.

    An id with several labels has their mean, rounded up; null labels don't count; an id that several rows have counts as often, always in the same half. The driver
    receives a row for each stratum, half, label and way to exceed cutoffs: a number that doesn't grow with the rows.
    """
    known = labels.filter("quality IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg((F.avg("quality") >= 0.5).alias("good"))
    held = counts.filter(~base_failed()).join(known, F.col("doc_id") == F.col("labelled"))
    value = measures()
    exceeded = [sum((value[rule] > c).cast("int") for c in grid).alias(rule) for rule, grid in GRID.items()]
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    groups = held.select(stratum().alias("stratum"), half, *exceeded, "good").groupBy("stratum", "half", *GRID)
    rows = groups.agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad")).collect()
    halves: dict[tuple[int, int], list] = {}
    for row in rows:
        halves.setdefault((row["stratum"], row["half"]), []).append((tuple(row[rule] for rule in GRID), row["n_good"], row["n_bad"]))
    return chosen({key: Marked.of(*map(list, zip(*groups))) for key, groups in halves.items()}, risk, delta)


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``docs (doc_id, text)`` and ``labels (doc_id, quality)`` to counts, ``base_failed`` and ``kept``, one row for each row of ``docs``.

    ``failed`` lists the rules that reject a text. Null and empty texts have no words and fail the base rule. Without enough labelled texts
    no rule is used, and everything that passes the base rule is kept. Repeated and null ids are judged like any other; an empty
    table gives no rows; other columns are ignored.
    """
    counts = settle(measure(docs))
    cutoffs = thresholds(counts, labels, risk, delta)
    value = measures()
    fired = [F.when((stratum() == s) & (value[rule] > cutoff), F.lit(rule)) for (s, rule), cutoff in sorted(cutoffs.items())]
    failed = F.array_compact(F.array(*fired)) if fired else F.array().cast("array<string>")
    judged = counts.withColumn("base_failed", base_failed()).withColumn("failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
