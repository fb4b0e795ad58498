"""The registered queries of this folder: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.llm import decontaminate, jaccard, licenses, lm, maintext, merkle, mixing, periods, quality, rules, secrets, toxicity, urls
from pressroom.llm.session import ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows where there is one."""

    def register(function):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return function(ready(spark), sf)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query(
    r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    linked AS (
      SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2)
      JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
    reached AS (
      SELECT doc_id, doc_id AS other FROM d
      UNION SELECT r.doc_id, l.y FROM reached r JOIN linked l ON l.x = r.other)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id
    FROM reached r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
    """
)
def op5_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents linked by the similarity of their word shingles."""
    return jaccard.jaccard_components(table(spark, sf, "documents"))


@query(
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (
      SELECT item_id, w, least(len(w), 10) AS k FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
    iw AS (
      SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
      FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM i)),
    dw AS (
      SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS g
      FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
    hit AS (SELECT dw.doc_id, dw.p, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
    hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
    it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id),
    posted AS (SELECT doc_id, w[p] AS term, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
    often AS (SELECT term, count(*) AS often FROM posted GROUP BY term),
    wt AS (SELECT item_id, p, w[p : p + k - 1] AS terms, unnest(w[p : p + k - 1]) AS term, unnest(range(1, k + 1)) AS place
           FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM i)),
    leads AS (
      SELECT item_id, list_distinct(any_value(terms)) AS terms, list(term ORDER BY often, place)[1:3] AS lead
      FROM (SELECT item_id, p, term, any_value(terms) AS terms, min(place) AS place FROM wt GROUP BY item_id, p, term) JOIN often USING (term)
      GROUP BY item_id, p HAVING count(*) >= 3),
    around AS (
      SELECT l.item_id, l.terms, l.lead, o.doc_id, o.p, d.w[greatest(o.p - 20, 1) : o.p + 20] AS near
      FROM leads l JOIN posted o ON o.term = l.lead[1] JOIN d ON d.doc_id = o.doc_id),
    inside AS (SELECT DISTINCT doc_id, item_id, unnest(range(p, p + k)) AS p FROM hit),
    close AS (
      SELECT doc_id, count(*) AS n_near FROM (
        SELECT DISTINCT doc_id, item_id, p FROM around
        WHERE list_has_all(near, lead) AND 10 * len(list_filter(terms, lambda x: list_contains(near, x))) >= 7 * len(terms)) c
      WHERE NOT EXISTS (SELECT 1 FROM inside s WHERE s.doc_id = c.doc_id AND s.item_id = c.item_id AND s.p = c.p) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN close USING (doc_id)
    """
)
def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of documents inside windows of benchmark items, and places of near matches."""
    found = decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", "n_near")


@query()
def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op3_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in all documents: pattern findings, their digest, and all spans."""
    found = secrets.secret_spans(table(spark, sf, "documents"))
    base = F.filter("spans", lambda x: x.kind != "learned")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    kinds = F.transform("spans", lambda x: x.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query(
    """
    WITH sizes AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source),
    weighed AS (SELECT *, size ** 0.5 AS weight FROM sizes),
    rated AS (
      SELECT source, CASE WHEN size > 0 THEN weight * sum(size) OVER () / (sum(CASE WHEN size > 0 THEN weight END) OVER () * size)
        ELSE 0 END AS rate FROM weighed),
    parts AS (
      SELECT doc_id, lang, d.source, n_chars, text, greatest(ceil(rate / 32.0), 1) AS parts, rate / greatest(ceil(rate / 32.0), 1) AS mean
      FROM documents d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source),
    draws AS (
      SELECT *, CAST(('0x' || md5(concat_ws('|', '17', CAST(doc_id AS VARCHAR), CAST(i AS VARCHAR)))[1:13]) AS BIGINT) / 4503599627370496.0 AS u
      FROM (SELECT *, unnest(range(1, CAST(parts AS BIGINT) + 1)) AS i FROM parts)),
    steps AS (
      SELECT source, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS reached
      FROM (SELECT DISTINCT source, mean FROM parts WHERE mean > 0), range(0, 120) AS t(k)),
    drawn AS (
      SELECT doc_id, lang, source, n_chars, text, sum((SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM x.source AND s.reached <= u)) AS copies
      FROM draws x GROUP BY ALL HAVING copies > 0),
    taken AS (SELECT * EXCLUDE (copies), CAST(unnest(range(1, CAST(copies AS BIGINT) + 1)) AS INTEGER) AS copy FROM drawn)
    SELECT *, CAST(('0x' || md5(concat_ws('|', '17|place', CAST(doc_id AS VARCHAR), CAST(copy AS VARCHAR)))[1:13]) AS BIGINT) AS place FROM taken
    """
)
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Documents repeated so that the sources meet their target weights."""
    return mixing.mix(table(spark, sf, "documents"))


@query()
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Documents judged by rules with risk-controlled cutoffs."""
    judged = rules.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """License notices in all documents."""
    found = licenses.license_scan(table(spark, sf, "documents"))
    spans = F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x.license, x.start, x.end, x.differences)), ",")
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), spans.alias("licenses"))


@query()
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op8_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Language-model scores of all documents."""
    return lm.lm_scores(table(spark, sf, "documents"))


@query()
def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    return urls.judge(table(spark, sf, "pages"), table(spark, sf, "labels"))


@query()
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of repeated words in all documents, with the digests of all runs and of the collapsed texts."""
    found = periods.periodic_runs(periods.repeated_tail(table(spark, sf, "documents")))
    best = periods.longest_repeat(F.col("runs"))
    line = lambda r: F.concat_ws(",", r.start, r.length, r.period)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, lang, coalesce(CAST(octet_length(encode(CAST(doc_id AS VARCHAR))) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR), '-')
          || coalesce(CAST(octet_length(encode(source)) AS VARCHAR) || ':' || source, '-') || coalesce(CAST(octet_length(encode(lang)) AS VARCHAR) || ':' || lang, '-') AS head,
        coalesce(CAST(octet_length(encode(text)) AS VARCHAR) || ':' || text, '-') AS tail, n_chars,
        list_reduce([4294967295::UBIGINT] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS UBIGINT)),
          lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda j: 0::UBIGINT), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))) AS crc
      FROM documents),
    hashed AS (
      SELECT doc_id, lang, sha256(head || coalesce(CAST(length(CAST(n_chars AS VARCHAR)) AS VARCHAR) || ':' || CAST(n_chars AS VARCHAR), '-') || tail) AS leaf,
        sha256(head || coalesce(CAST(length(CAST(n AS VARCHAR)) AS VARCHAR) || ':' || CAST(n AS VARCHAR), '-') || tail) AS given
      FROM (SELECT *, CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS n FROM d)),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM hashed),
    nodes AS (
      SELECT lang, 0 AS lvl, rank AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS m FROM leaves
      UNION ALL
      SELECT lang, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (m + 1) // 2 FROM nodes WHERE m > 1 GROUP BY lang, lvl, i // 2, m),
    tops AS (SELECT lang, lvl, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE m = 1),
    upper AS (
      SELECT 0 AS lvl, place AS i, subroot AS h, count(*) OVER () AS m FROM tops
      UNION ALL
      SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (m + 1) // 2 FROM upper WHERE m > 1 GROUP BY lvl, i // 2, m),
    steps AS (
      SELECT l.doc_id, l.lang, l.rank, t.subroot, l.leaf, l.given, n.lvl, n.m > 1 AS used, s.h AS sibling, (l.rank >> n.lvl) % 2 AS odd
      FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang
      JOIN (SELECT DISTINCT lang, lvl, m FROM nodes) n ON n.lang IS NOT DISTINCT FROM l.lang AND n.m > 1
      LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lvl = n.lvl AND s.i = xor(l.rank >> n.lvl, 1)
      UNION ALL
      SELECT l.doc_id, l.lang, l.rank, t.subroot, l.leaf, l.given, 100 + u.lvl, true, s.h, (t.place >> u.lvl) % 2
      FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang JOIN (SELECT DISTINCT lvl, m FROM upper WHERE m > 1) u ON true
      LEFT JOIN upper s ON s.lvl = u.lvl AND s.i = xor(t.place >> u.lvl, 1)),
    paths AS (
      SELECT lang, rank, list(CASE WHEN sibling IS NULL THEN ['', ''] WHEN odd = 1 THEN [sibling, ''] ELSE ['', sibling] END ORDER BY lvl) AS path,
        string_agg(coalesce(sibling, ''), '' ORDER BY lvl) AS siblings
      FROM steps GROUP BY lang, rank)
    SELECT l.doc_id, l.leaf, t.subroot, r.h AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
      list_reduce([['', l.given]] || coalesce(path, []), lambda a, s: ['', sha256(s[1] || a[2] || s[2])])[2] AS folded_root,
      list_reduce([['', l.given]] || coalesce(path, []), lambda a, s: ['', sha256(s[1] || a[2] || s[2])])[2] = r.h AS verified
    FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.rank = l.rank
    CROSS JOIN (SELECT h FROM upper WHERE m = 1) r
    """
)
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, and the roots that partly tampered leaves give."""
    docs = table(spark, sf, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    plain = {f: F.col(f) for f in fields}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = plain | {"n_chars": F.when(chosen, F.col("n_chars").cast("decimal(20)") + 1).otherwise(F.col("n_chars").cast("decimal(20)"))}
    given = merkle.digest(*changed.values()).alias("given")
    found = merkle.merkle_manifest(docs, F.col("lang"), [F.col("doc_id")], merkle.digest(*plain.values()), F.col("doc_id"), given)
    root = merkle.folded(F.col("given"), F.col("path"))
    found = found.withColumn("folded_root", root)
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


@query()
def op13_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of all pages."""
    return maintext.extract_main_text(table(spark, sf, "pages"))
