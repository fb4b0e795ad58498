"""URL filters: listed rules first, then association rules mined from labelled pages by FP-growth.

A URL is a set of tokens: the labels of its host, its path segments and its query keys. Frequent sets of tokens that come with unwanted pages with
enough confidence become rules. A URL is matched by an inverted index from tokens to rules: a rule fits
when all of its tokens were counted.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pressroom.session import settle

#: Rules as host and path, and their verdicts.
LISTED = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Least share of labelled pages with the tokens and the label, least lower bound of the rule's confidence. At most
#: (tokens of a URL) / LEAST_SUPPORT tokens can be frequent, however many pages there are.
LEAST_SUPPORT, LEAST_CONFIDENCE = 0.004, 0.6
UNWANTED = "label:unwanted"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed(host: Column, path: Column, rules=tuple(LISTED)) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, said in sorted(rules, key=lambda x: (len(x[0] + x[1]), x)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(f"{kind}:"), x))
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_distinct(F.concat(named("host", F.split(host, r"\.")), named("path", F.split(path, "/")), named("query", keys)))


def companions(known: DataFrame, least: float) -> list[tuple[str, ...]]:
    """Groups of tokens that stand on exactly the same rows of ``known (row, tokens)``, of those that at least ``least`` rows have. Rows are compared by their number and
    two hashes over all of them. Only frequent tokens reach the driver, so their number is bounded."""
    each = known.select("row", F.explode("tokens").alias("token"))
    over = lambda seed: F.bit_xor(F.xxhash64("row", F.lit(seed)))
    signed = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), over(1).alias("first"), over(2).alias("second")).filter(F.col("n") >= least)
    groups: dict[tuple, list[str]] = defaultdict(list)
    for r in signed.collect():
        groups[r["n"], r["first"], r["second"]].append(r["token"])
    return sorted(tuple(sorted(group)) for group in groups.values())


def mine(pages: DataFrame, labels: DataFrame, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE) -> list[tuple[float, tuple[str, ...]]]:
    """Rules as (confidence, tokens), the surest first. A page is labelled by the row of its id: unwanted means toxic or of low quality.

    Tokens that always come together on labelled pages are one item to FP-growth, so a long path that many pages share is a single item and not every set of its segments;
    a rule has all tokens of its items. A rule that holds a shorter one at least as sure is left out. Every labelled page counts.
    """
    unwanted = labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("unwanted")
    )
    known = pages.join(unwanted, F.col("page_id") == F.col("labelled")).select("tokens", "unwanted")
    known = settle(known.withColumn("row", F.monotonically_increasing_id()))
    rows = known.count()
    if not rows:
        return []
    groups = companions(known, support * rows)
    item_of = {token: str(k) for k, group in enumerate(groups) for token in group}

    @F.pandas_udf("array<string>")
    def items(found: pd.Series) -> pd.Series:
        return found.map(lambda x: sorted({item_of[t] for t in x if t in item_of}))

    marked = F.when(F.col("unwanted"), F.array(F.lit(UNWANTED))).otherwise(F.array().cast("array<string>"))
    sets = known.select(F.concat(items("tokens"), marked).alias("items"))
    frequent = FPGrowth(itemsCol="items", minSupport=support).fit(sets).freqItemsets
    sized = frequent.withColumn("key", F.concat_ws("\n", F.sort_array(F.array_remove("items", UNWANTED))))
    marked = F.array_contains("items", UNWANTED)
    both = sized.filter(marked & (F.size("items") > 1)).select("key", F.col("freq").alias("both"))
    rules = both.join(sized.filter(~marked).select("key", "freq"), "key")
    share, z = F.col("both") / F.col("freq"), 1.96
    lower = (share + z * z / (2 * F.col("freq")) - z * F.sqrt(share * (1 - share) / F.col("freq") + z * z / (4 * F.col("freq") ** 2))) / (1 + z * z / F.col("freq"))
    found = rules.withColumn("lower", lower).filter(F.col("lower") >= confidence).collect()  # bounded by the support
    whole = [(r["lower"], tuple(sorted(t for k in r["key"].split("\n") for t in groups[int(k)]))) for r in found]
    kept: list[tuple[float, tuple[str, ...]]] = []
    for low, rule in sorted(whole, key=lambda x: (-x[0], len(x[1]), x[1])):
        if not any(set(other) <= set(rule) for _, other in kept):
            kept.append((low, rule))
    return kept


def matcher(rules: list[tuple[float, tuple[str, ...]]]):
    """A column function: the surest rule whose tokens are all in a URL, else null."""
    index = defaultdict(list)
    for k, (_, rule) in enumerate(rules):
        for token in rule:
            index[token].append(k)
    sizes = [len(rule) for _, rule in rules]
    names = [" & ".join(rule) for _, rule in rules]

    def surest(found) -> str | None:
        counted: dict[int, int] = defaultdict(int)
        for token in found:
            for k in index.get(token, ()):
                counted[k] += 1
        best = min((k for k, n in counted.items() if n == sizes[k]), default=None)
        return None if best is None else names[best]

    @F.pandas_udf(StringType())
    def match(found: pd.Series) -> pd.Series:
        return found.map(surest)

    return match


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``pages (page_id, url)`` and ``labels (doc_id, quality, toxic)`` to ``(page_id, host, path, rule, verdict, mined)``, one row for each
    row of ``pages``.

    ``rule`` is the longest listed rule that fits, which decides. Where none fits, ``mined`` is the surest mined rule that fits, and such a page is blocked; all others
    are allowed. A null url, or one without ``://``, has an empty host and path and is allowed. Repeated and null ids are judged like any other; without
    labels nothing is mined; other columns are ignored; an empty table gives no rows.
    """
    parts = pages.select("page_id", "url").withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    parts = parts.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    rules = mine(parts, labels)
    rule, verdict = listed(F.col("host"), F.col("path"))
    mined = matcher(rules)(F.col("tokens")) if rules else F.lit(None).cast("string")
    judged = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), mined.alias("fits"))
    judged = judged.withColumn("mined", F.when(F.col("rule").isNull(), F.col("fits")))
    verdict = F.coalesce("said", F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "mined")
