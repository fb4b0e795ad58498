"""Paths, extraction and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as i
from checks.duck import stamp
from checks.registry import query
from pressroom import config
from pressroom.functions import text
from pressroom.operators import articles as art
from pressroom.operators import extraction, paths, registry
from pressroom.operators import path_cache as cache

AS_OF = "2024-01-30 00:00:00"
AS_OF_SQL = "TIMESTAMP '2024-01-30 00:00:00'"

# ---------------------------------------------------------------------- text and URLs

_URL_PATH = "regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''), '^[^/]*', '')"


@query(f"SELECT page_id, {_URL_PATH} AS path FROM pages")
def url_path(spark, sf):
    return i.read(spark, sf, "pages").select("page_id", text.url_path(F.col("url")).alias("path"))


@query("SELECT page_id, split_part(url, '&', 1) AS url FROM pages")
def strip_suffix(spark, sf):
    return i.read(spark, sf, "pages").select("page_id", text.strip_query_suffix(F.col("url")).alias("url"))


@query(
    f"""
    SELECT event_id,
           CASE event_id % 4 WHEN 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')
                             WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS published,
           CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN {stamp("ts + INTERVAL '6 hours'")}
                ELSE {stamp('ts')} END AS moment
    FROM events
    """
)
def parse_dates(spark, sf):
    """Publish dates with and without fraction, offsets, and text that is no date."""
    rows = i.read(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kind = F.col("event_id") % 4
    written = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'-06:00'"))
        .otherwise(F.concat(F.lit("on "), F.date_format("ts", "yyyy-MM-dd")))
    )
    return rows.select(
        "event_id",
        text.parse_publish_date(written).alias("published"),
        text.to_utc(written).alias("moment"),
    )


_PREFIXES = ("/fr", "/de")


@query(
    f"""
    SELECT page_id, path, CASE WHEN path LIKE '/fr%' OR path LIKE '/de%' THEN 'excluded' ELSE 'kept' END AS side
    FROM (SELECT page_id, {_URL_PATH} AS path FROM pages)
    """
)
def prefix_exclusion(spark, sf):
    kept, excluded = paths.split_by_prefix(url_path(spark, sf), "path", _PREFIXES)
    return kept.withColumn("side", F.lit("kept")).unionByName(excluded.withColumn("side", F.lit("excluded")))


# ------------------------------------------------------------------------ which paths

_TO_UPDATE = """
    SELECT e.site, e.landing_page_path, p.external_id
    FROM (SELECT DISTINCT site, landing_page_path FROM events_agg) e
    LEFT JOIN paths p ON p.path = e.landing_page_path AND p.site = e.site
    LEFT JOIN articles a ON a.external_id = p.external_id AND a.site = p.site
    WHERE p.exclude_reason IS NULL AND (p.external_id IS NULL OR a.published_at IS NULL
          OR a.published_at > CAST(DATE '2024-01-15' - 1 AS TIMESTAMP))
"""


def _to_update(spark, sf):
    return paths.paths_to_update(
        i.stored_events(spark, sf), i.paths(spark, sf), i.articles(spark, sf), "2024-01-15"
    )


@query(_TO_UPDATE, "events_agg paths articles")
def paths_to_update(spark, sf):
    return _to_update(spark, sf)


@query(
    f"""
    SELECT DISTINCT site, CASE WHEN external_id IS NULL THEN 'new' ELSE 'refresh' END AS kind,
           coalesce(external_id, landing_page_path) AS key FROM ({_TO_UPDATE})
    """,
    "events_agg paths articles",
)
def split_new_refresh(spark, sf):
    rows = _to_update(spark, sf)
    new = paths.new_paths(rows).select("site", F.lit("new").alias("kind"), F.col("landing_page_path").alias("key"))
    again = paths.refresh_ids(rows).select("site", F.lit("refresh").alias("kind"), F.col("external_id").alias("key"))
    return new.unionByName(again)


# -------------------------------------------------------------------------------- ids

_ID_PATTERN = r"^/([a-z]{2})/([0-9]+)"
_ID_SQL = "nullif(regexp_extract(path, '^/([a-z]{2})/([0-9]+)', 2), '')"
_EXTRACTED = f"""
    (SELECT 'site-' || CAST((CAST({_ID_SQL} AS BIGINT) + 2) % 3 AS VARCHAR) AS site, path, {_ID_SQL} AS external_id
     FROM (SELECT DISTINCT {_URL_PATH} AS path FROM pages))
"""


def _extracted(spark, sf):
    """Distinct page paths with the id in them; its site is that of article ``id - 100``."""
    rows = extraction.id_from_path(url_path(spark, sf).select("path").distinct(), _ID_PATTERN, 2)
    return rows.withColumn("site", i.site_of(F.col("external_id").try_cast("bigint") + 2))


@query(f"SELECT page_id, path, {_ID_SQL} AS external_id, "
       f"CASE WHEN {_ID_SQL} IS NULL THEN 'no_external_id' END AS error_type "
       f"FROM (SELECT page_id, {_URL_PATH} AS path FROM pages)")
def id_from_path(spark, sf):
    return extraction.id_from_path(url_path(spark, sf), _ID_PATTERN, 2).drop("msg")


@query(
    f"""
    SELECT page_id, path, CASE WHEN error_type IS NULL THEN CAST(page_id AS VARCHAR) END AS external_id, error_type
    FROM (SELECT page_id, path,
                 CASE WHEN path LIKE '/fr%' THEN 'no_external_id' WHEN url LIKE '%#%' THEN 'fetch_error'
                      WHEN url LIKE '%?%' THEN 'no_external_id' END AS error_type
          FROM (SELECT page_id, url, {_URL_PATH} AS path FROM pages))
    """
)
def id_from_html(spark, sf):
    """Content ids in page scripts; pages with ``?`` carry none, those with ``#`` failed."""
    script = F.concat(F.lit("<script>x = {contentID: '00"), i.text(F.col("page_id")), F.lit("'}</script>"))
    responses = i.read(spark, sf, "pages").select(
        "page_id",
        text.url_path(F.col("url")).alias("path"),
        F.when(F.contains("url", F.lit("?")), F.col("html")).otherwise(F.concat("html", script)).alias("body"),
        F.when(F.contains("url", F.lit("#")), 404).otherwise(200).alias("status"),
    )
    return extraction.id_from_html(responses, ("/fr",)).select("page_id", "path", "external_id", "error_type")


def _json(*columns, **options):
    return F.to_json(F.struct(*columns), options)


def _lookup_bodies(spark, sf):
    """Content-lookup answers: whole documents as payload, source system by language."""
    n = F.col("doc_id")
    system = (
        F.when(F.col("lang") == "en", "composer")
        .when(F.col("lang") == "fr", "ellipsis")
        .when(F.col("lang") == "es", "airtable")
        .otherwise("wires")
    )
    home = F.when(F.col("n_chars") % 5 == 0, config.TEST_SITE).otherwise("/news")
    body = _json(
        F.when(n % 17 != 0, F.concat(F.lit("ARC"), i.text(n))).alias("_id"),
        F.col("text").alias("content"),
        F.struct(system.alias("system")).alias("source"),
        F.struct(F.array(F.struct(home.alias("_id"))).alias("sites")).alias("taxonomy"),
    )
    return i.read(spark, sf, "documents").select(
        n,
        F.concat(F.lit("/"), "source", F.lit("/"), i.text(n), F.lit("&cid=x")).alias("path"),
        F.when(n % 13 == 0, 500).otherwise(200).alias("status"),
        body.alias("body"),
    )


@query(
    """
    SELECT doc_id, CASE WHEN error_type IS NULL OR late THEN 'ARC' || CAST(doc_id AS VARCHAR) END AS external_id,
           error_type
    FROM (SELECT doc_id,
                 CASE WHEN source LIKE 'src1%' THEN 'failed_site_validation' WHEN doc_id % 13 = 0 THEN 'fetch_error'
                      WHEN doc_id % 17 = 0 THEN 'no_external_id'
                      WHEN lang NOT IN ('en', 'fr', 'es') OR n_chars % 5 = 0 THEN 'failed_site_validation' END AS error_type,
                 source NOT LIKE 'src1%' AND doc_id % 13 <> 0 AND doc_id % 17 <> 0 AS late
          FROM documents)
    """
)
def id_from_json(spark, sf):
    found = extraction.id_from_api_json(_lookup_bodies(spark, sf), ("/src1",))
    return found.select("doc_id", "external_id", "error_type")


@query(
    f"SELECT site, path, external_id FROM {_EXTRACTED} x WHERE (site, external_id) IN "
    "(SELECT (site, external_id) FROM stored_articles)",
    "stored_articles",
)
def known_ids(spark, sf):
    return art.known_ids(_extracted(spark, sf), i.stored_articles(spark, sf)).select("site", "path", "external_id")


@query(
    f"SELECT site, path, external_id FROM {_EXTRACTED} x WHERE NOT EXISTS "
    "(SELECT 1 FROM stored_articles a WHERE a.site = x.site AND a.external_id = x.external_id)",
    "stored_articles",
)
def unknown_ids(spark, sf):
    return art.unknown_ids(_extracted(spark, sf), i.stored_articles(spark, sf)).select("site", "path", "external_id")


_NEW = f"""
    SELECT site, min(path) AS path, external_id FROM {_EXTRACTED} x WHERE external_id IS NOT NULL AND NOT EXISTS
    (SELECT 1 FROM stored_articles a WHERE a.site = x.site AND a.external_id = x.external_id)
    GROUP BY site, external_id
"""


@query(_NEW, "stored_articles")
def new_articles(spark, sf):
    return art.new_articles(_extracted(spark, sf), i.stored_articles(spark, sf))


@query(
    f"""
    SELECT x.site, x.path, x.external_id, 'duplicate_path' AS error_type
    FROM {_EXTRACTED} x LEFT JOIN ({_NEW}) n ON n.site = x.site AND n.path = x.path AND n.external_id = x.external_id
    WHERE x.external_id IS NOT NULL AND n.path IS NULL
    """,
    "stored_articles",
)
def duplicate_paths(spark, sf):
    return art.duplicate_paths(_extracted(spark, sf), i.stored_articles(spark, sf)).drop("msg")


@query(
    "SELECT id, site, external_id, path FROM articles WHERE (site, path) IN (SELECT (site, path) FROM paths)",
    "articles paths",
)
def articles_by_path(spark, sf):
    return art.articles_by_path(i.articles(spark, sf), i.paths(spark, sf)).select("id", "site", "external_id", "path")


# --------------------------------------------------------------------------- metadata


@query(
    f"""
    SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(
             regexp_extract(html, '<h1>([^<]*)</h1>', 1),
             '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')) AS title,
           {_URL_PATH} AS new_path, CAST(NULL AS VARCHAR) AS error_type
    FROM pages
    """
)
def html_titles(spark, sf):
    """Titles of whole pages, with the heading selector these pages use. HTML also reads an
    ``&amp`` that lost its semicolon."""
    responses = i.read(spark, sf, "pages").select(
        "page_id",
        "url",
        F.lit(200).alias("status"),
        F.col("html").alias("body"),
        i.text(F.col("page_id")).alias("external_id"),
    )
    found = extraction.metadata_from_html(responses, ("article", "h1"))
    return found.select("page_id", "title", "new_path", "error_type")


_HEADLINE = "CASE WHEN doc_id % 3 = 0 THEN source || ' ' || lang ELSE text END"


@query(f"SELECT doc_id, md5({_HEADLINE}) AS headline FROM documents")
def headline(spark, sf):
    """A search title where there is one (for every third document, some empty), else the text."""
    n = F.col("doc_id")
    meta = F.when(n % 3 == 0, F.concat("source", F.lit(" "), "lang")).when(n % 3 == 1, F.lit(""))
    body = _json(F.struct(meta.alias("meta_title"), F.col("text").alias("basic")).alias("headlines"))
    parsed = i.read(spark, sf, "documents").select(n, F.from_json(body, extraction.ARC_ARTICLE).alias("j"))
    title = text.headline(F.col("j.headlines.meta_title"), F.col("j.headlines.basic"))
    return parsed.select("doc_id", F.md5(title).alias("headline"))


_DAY_SQL = "DATE '2024-01-01' + CAST(doc_id % 90 AS INT)"


def tribune_bodies(spark, sf):
    """Article answers with the whole text as headline; every 17th lacks its date key,
    every 13th has a null date."""
    n = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (n % 90).cast("int"))
    stamp_text = F.when(n % 13 != 0, F.concat(i.text(day), F.lit("T12:45:35-06:00"))).alias("pub_date")
    headline_text = F.col("text").alias("headline")
    url = F.concat(F.lit("https://www.example.org"), i.article_path(n), F.lit("?x=1")).alias("url")
    keep = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct(headline_text, stamp_text, url, n.alias("id")), keep)
    short = F.to_json(F.struct(headline_text, url, n.alias("id")), keep)
    return i.read(spark, sf, "documents").select(
        n,
        i.site_of(n).alias("site"),
        i.article_path(n).alias("path"),
        i.text(n).alias("external_id"),
        F.when(n % 17 == 0, short).otherwise(whole).alias("body"),
        F.lit(200).alias("status"),
    )


@query(
    f"""
    SELECT doc_id, md5(text) AS title,
           CASE WHEN doc_id % 17 <> 0 AND doc_id % 13 <> 0
                THEN strftime({_DAY_SQL} + INTERVAL '18 hours 45 minutes 35 seconds', '%Y-%m-%d %H:%M:%S') END AS published_at,
           '/article/' || CAST(100 + doc_id AS VARCHAR) || '/slug-' || CAST(doc_id AS VARCHAR) AS new_path,
           CAST(doc_id AS VARCHAR) AS new_external_id,
           CASE WHEN doc_id % 17 = 0 THEN 'malformed_api_response' END AS error_type
    FROM documents
    """
)
def tribune_json(spark, sf):
    found = extraction.metadata_from_tribune_json(tribune_bodies(spark, sf))
    return found.select(
        "doc_id", F.md5("title").alias("title"), "published_at", "new_path", "new_external_id", "error_type"
    )


def _arc_item(n):
    """Whole document as a content-API article. By doc_id: every 19th has no headline, 23rd no
    URL, 29th no date, 31st a date that is none; even ids have fractions of seconds."""
    day = i.text(F.date_add(F.lit("2024-01-01").cast("date"), (n % 90).cast("int")))
    moment = F.when(n % 2 == 0, F.concat(day, F.lit("T18:37:44.250Z"))).otherwise(
        F.concat(day, F.lit("T18:37:44Z"))
    )
    moment = F.when(n % 31 == 0, F.lit("yesterday")).otherwise(moment)
    return F.struct(
        F.struct(
            F.when(n % 3 == 0, F.col("source")).when(n % 3 == 1, F.lit("")).alias("meta_title"),
            F.when(n % 19 != 0, F.col("text")).alias("basic"),
        ).alias("headlines"),
        F.when(n % 29 != 0, moment).alias("publish_date"),
        F.concat(F.lit("ARC"), i.text(n)).alias("_id"),
        F.when(n % 23 != 0, i.article_path(n)).alias("canonical_url"),
    )


def _arc_bodies(spark, sf):
    n = F.col("doc_id")
    return i.read(spark, sf, "documents").select(
        n, F.to_json(_arc_item(n)).alias("body"), F.lit(200).alias("status")
    )


_ARC_ERROR = """CASE WHEN doc_id % 19 = 0 THEN 'Article missing headline'
    WHEN doc_id % 23 = 0 THEN 'Article canonical URL missing' WHEN doc_id % 29 = 0 THEN 'Article publish date missing'
    WHEN doc_id % 31 = 0 THEN 'Cannot parse date of publication' END"""
_ARC_MOMENT = f"""CASE WHEN doc_id % 29 <> 0 AND doc_id % 31 <> 0
    THEN strftime({_DAY_SQL} + INTERVAL '18 hours 37 minutes 44 seconds', '%Y-%m-%d %H:%M:%S') END"""
_ARC_TITLE = "CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 19 <> 0 THEN text END"


@query(
    f"""
    SELECT doc_id, md5({_ARC_TITLE}) AS title, {_ARC_MOMENT} AS published_at,
           CASE WHEN doc_id % 23 <> 0 THEN '/article/' || CAST(100 + doc_id AS VARCHAR) || '/slug-'
                || CAST(doc_id AS VARCHAR) END AS new_path,
           'ARC' || CAST(doc_id AS VARCHAR) AS new_external_id,
           CASE WHEN ({_ARC_ERROR}) IS NOT NULL THEN 'malformed_api_response' END AS error_type
    FROM documents
    """
)
def arc_json(spark, sf):
    found = extraction.metadata_from_arc_json(_arc_bodies(spark, sf))
    return found.select(
        "doc_id", F.md5("title").alias("title"), "published_at", "new_path", "new_external_id", "error_type"
    )


@query(f"SELECT doc_id, {_ARC_ERROR} AS msg FROM documents")
def validate_first_error(spark, sf):
    rows = _arc_bodies(spark, sf).withColumn("j", F.from_json("body", extraction.ARC_ARTICLE))
    return extraction.validate(rows, extraction.arc_rules("j")).select("doc_id", "msg")


PAGE_SIZE = 100  # articles per listing, as the content APIs page them


@query(
    f"""
    SELECT site, external_id, title, path, published_at, error_type FROM (
        SELECT 'arc' AS site, 'ARC' || CAST(doc_id AS VARCHAR) AS external_id, md5({_ARC_TITLE}) AS title,
               CASE WHEN doc_id % 23 <> 0 THEN '/article/' || CAST(100 + doc_id AS VARCHAR) || '/slug-'
                    || CAST(doc_id AS VARCHAR) END AS path,
               {_ARC_MOMENT} AS published_at,
               CASE WHEN ({_ARC_ERROR}) IS NOT NULL THEN 'malformed_api_response' END AS error_type
        FROM documents)
    WHERE error_type IS NOT NULL OR (published_at >= '2024-01-10' AND published_at < '2024-02-20')
    """
)
def bulk_articles(spark, sf):
    """Listings of a hundred whole documents each, cut to a range of publish dates."""
    n = F.col("doc_id")
    listed = F.struct(F.collect_list("item").alias("content_elements"))
    responses = (
        i.read(spark, sf, "documents")
        .select(F.floor(n / PAGE_SIZE).alias("page"), _arc_item(n).alias("item"))
        .groupBy("page")
        .agg(F.to_json(listed).alias("body"))
        .select(F.lit("arc").alias("site"), F.lit(200).alias("status"), "body")
    )
    found = extraction.bulk_from_arc(responses, "2024-01-10", "2024-02-20")
    return found.withColumn("title", F.md5("title")).drop("msg")


@query(
    f"""
    SELECT site, external_id, md5(text) AS title, path, published_at FROM (
        SELECT 'site-' || CAST(doc_id % 3 AS VARCHAR) AS site, CAST(doc_id AS VARCHAR) AS external_id, text,
               '/article/' || CAST(100 + doc_id AS VARCHAR) || '/slug-' || CAST(doc_id AS VARCHAR) AS path,
               strftime({_DAY_SQL} + INTERVAL '18 hours 45 minutes 35 seconds', '%Y-%m-%d %H:%M:%S') AS published_at,
               doc_id
        FROM documents)
    WHERE doc_id % 17 <> 0 AND doc_id % 13 <> 0 AND published_at >= '2024-01-10' AND published_at < '2024-02-20'
    """
)
def bulk_articles_tribune(spark, sf):
    n = F.col("doc_id")
    bodies = tribune_bodies(spark, sf)
    pages = bodies.groupBy("site", F.floor(n / PAGE_SIZE).alias("page")).agg(F.collect_list("body").alias("items"))
    body = F.concat(F.lit('{"results":['), F.array_join("items", ","), F.lit("]}"))
    responses = pages.select("site", F.lit(200).alias("status"), body.alias("body"))
    found = extraction.bulk_from_tribune(responses, "2024-01-10", "2024-02-20")
    good = found.filter(F.col("error_type").isNull())
    return good.withColumn("title", F.md5("title")).drop("error_type", "msg")


# ------------------------------------------------------------------------ maintenance


def _scraped(spark, sf):
    """Every document as a scraped article: its whole text as title, a longer path."""
    n = F.col("doc_id")
    return i.read(spark, sf, "documents").select(
        i.site_of(n).alias("site"),
        i.article_path(n).alias("path"),
        i.text(n + 100).alias("external_id"),
        F.col("text").alias("title"),
        F.when(n % 17 != 0, F.lit("2024-01-29 06:00:00").cast("timestamp")).alias("published_at"),
        F.concat(F.lit("/final"), i.article_path(n)).alias("new_path"),
        F.when(n % 11 == 0, "fetch_error").alias("error_type"),
        F.when(n % 11 == 0, "Page was not fetched").alias("msg"),
    )


_SCRAPED_VIEW = """
    (SELECT 'site-' || CAST(doc_id % 3 AS VARCHAR) AS site, CAST(100 + doc_id AS VARCHAR) AS external_id, text AS title,
            '/final/article/' || CAST(100 + doc_id AS VARCHAR) || '/slug-' || CAST(doc_id AS VARCHAR) AS path,
            TIMESTAMP '2024-01-29 06:00:00' AS published_at
     FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 11 <> 0)
"""


def _article_columns(prefix: str = "") -> str:
    return (
        f"{prefix}id, {prefix}site, {prefix}external_id, md5({prefix}title) AS title, {prefix}path, "
        f"{stamp(prefix + 'published_at')} AS published_at, {stamp(prefix + 'created_at')} AS created_at, "
        f"{stamp(prefix + 'updated_at')} AS updated_at"
    )


def _short(snapshot):
    return snapshot.withColumn("title", F.md5("title"))


@query(
    f"""
    SELECT {_article_columns()} FROM (
        SELECT * FROM stored_articles UNION ALL BY NAME
        SELECT (SELECT max(id) FROM stored_articles) + row_number() OVER (ORDER BY s.site, s.external_id) AS id,
               s.site, s.external_id, s.title, s.path, s.published_at, {AS_OF_SQL} AS created_at, {AS_OF_SQL} AS updated_at
        FROM {_SCRAPED_VIEW} s ANTI JOIN stored_articles a ON a.site = s.site AND a.external_id = s.external_id)
    """,
    "stored_articles",
)
def create_articles(spark, sf):
    return _short(art.create_articles(i.stored_articles(spark, sf), _scraped(spark, sf), AS_OF)[0])


@query(
    f"""
    SELECT {_article_columns()} FROM (
        SELECT a.id, a.site, a.external_id, coalesce(s.title, a.title) AS title, coalesce(s.path, a.path) AS path,
               coalesce(s.published_at, a.published_at) AS published_at, a.created_at,
               CASE WHEN s.path IS NOT NULL THEN {AS_OF_SQL} ELSE a.updated_at END AS updated_at
        FROM stored_articles a LEFT JOIN {_SCRAPED_VIEW} s ON a.site = s.site AND a.external_id = s.external_id)
    """,
    "stored_articles",
)
def refresh_articles(spark, sf):
    return _short(art.refresh_articles(i.stored_articles(spark, sf), _scraped(spark, sf), AS_OF)[0])


def _label_errors(spark, sf):
    """Refresh errors of labelled articles: toxic ones carry the exclude tag, poor ones
    only lack a usable response."""
    rows = i.articles(spark, sf).join(i.labelled(spark, sf), "id")
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    return rows.filter(toxic | poor).select(
        "site",
        "path",
        "external_id",
        F.when(toxic, "failed_site_validation").otherwise("malformed_api_response").alias("error_type"),
        F.when(toxic, config.EXCLUDE_TAG_MESSAGE).otherwise("No title on the page").alias("msg"),
    )


@query(
    f"""
    SELECT {_article_columns()} FROM articles
    WHERE id NOT IN (SELECT id FROM labelled WHERE toxic = 1)
    """,
    "articles labelled",
)
def delete_excluded(spark, sf):
    left = art.delete_excluded_articles(
        i.articles(spark, sf), _label_errors(spark, sf), config.EXCLUDE_TAG_MESSAGE
    )
    return _short(left)


@query(
    f"""
    SELECT {_article_columns()} FROM (
        SELECT a.id, a.site, a.external_id, coalesce(s.title, a.title) AS title, coalesce(s.path, a.path) AS path,
               coalesce(s.published_at, a.published_at) AS published_at, a.created_at,
               CASE WHEN s.path IS NOT NULL THEN {AS_OF_SQL} ELSE a.updated_at END AS updated_at
        FROM stored_articles a LEFT JOIN {_SCRAPED_VIEW} s ON a.site = s.site AND a.external_id = s.external_id
        UNION ALL BY NAME
        SELECT (SELECT max(id) FROM stored_articles) + row_number() OVER (ORDER BY s.site, s.external_id) AS id,
               s.site, s.external_id, s.title, s.path, s.published_at, {AS_OF_SQL} AS created_at, {AS_OF_SQL} AS updated_at
        FROM {_SCRAPED_VIEW} s ANTI JOIN stored_articles a ON a.site = s.site AND a.external_id = s.external_id)
    """,
    "stored_articles",
)
def upsert_articles(spark, sf):
    good = _scraped(spark, sf).filter(F.col("error_type").isNull() & F.col("published_at").isNotNull())
    bulk = good.withColumn("path", F.col("new_path"))
    return _short(art.upsert_articles(i.stored_articles(spark, sf), bulk, AS_OF))


@query(
    """
    SELECT error_type, msg, count(*) AS n FROM (
        SELECT 'no_publish_date' AS error_type, '' AS msg FROM documents WHERE doc_id % 17 = 0 AND doc_id % 11 <> 0
        UNION ALL SELECT 'fetch_error', 'Page was not fetched' FROM documents WHERE doc_id % 11 = 0
        UNION ALL SELECT CASE WHEN toxic = 1 THEN 'failed_site_validation' ELSE 'malformed_api_response' END,
                         CASE WHEN toxic = 1 THEN 'Article has exclude tag' ELSE 'No title on the page' END
                  FROM labels WHERE toxic = 1 OR quality = 0)
    GROUP BY ALL
    """
)
def scrape_errors(spark, sf):
    """Failures of creating and refreshing in one table, counted by kind."""
    scraped = _scraped(spark, sf)
    undated = art.refresh_articles(i.articles(spark, sf), scraped, AS_OF)[1]
    whole = art.scrape_errors(undated, art.failed_scrapes(scraped), _label_errors(spark, sf))
    return whole.groupBy("error_type", "msg").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""
    SELECT site, path, external_id, exclude_reason, {stamp('min(created_at)')} AS created_at FROM (
        SELECT site, path, created_at,
               first_value(external_id) OVER w AS external_id, first_value(exclude_reason) OVER w AS exclude_reason
        FROM (
            SELECT site, path, external_id, exclude_reason, created_at,
                   CASE WHEN exclude_reason IS NOT NULL THEN 0 ELSE 2 END AS rank FROM paths
            UNION ALL
            SELECT a.site, a.path, NULL, 'failed_site_validation', {AS_OF_SQL}, 0
            FROM articles a JOIN labelled l USING (id) WHERE l.toxic = 1
            UNION ALL
            SELECT site, p, external_id, NULL, {AS_OF_SQL}, 1
            FROM (SELECT site, unnest([replace(path, '/final', ''), path]) AS p, external_id FROM {_SCRAPED_VIEW})
        ) e
        WINDOW w AS (PARTITION BY site, path ORDER BY rank, created_at, external_id, exclude_reason))
    GROUP BY site, path, external_id, exclude_reason
    """,
    "paths articles labelled",
)
def path_cache(spark, sf):
    """Stored entries, exclusions, and both paths of everything created."""
    scraped = _scraped(spark, sf).filter(F.col("error_type").isNull() & F.col("published_at").isNotNull())
    updated = cache.update_path_cache(i.paths(spark, sf), scraped, _label_errors(spark, sf), AS_OF)
    return updated.drop("updated_at")


@query(
    f"SELECT id, type, status, site, {stamp('created_at')} AS created_at, {stamp('updated_at')} AS updated_at "
    "FROM promoted_models",
    "promoted_models",
)
def promote_model(spark, sf):
    """The newest pending model of every type and site becomes current."""
    models = i.models(spark, sf)
    return registry.promote_models(models, i.newest_pending(models), AS_OF)


_REC_COLUMNS = "'default' AS source_entity_id, l_partkey AS recommended_article_id, round(l_discount, 6) AS score, l_orderkey AS model_id"


@query(
    f"SELECT {_REC_COLUMNS} FROM lineitem WHERE l_orderkey IN (SELECT id FROM promoted_models)",
    "promoted_models",
)
def live_recs(spark, sf):
    models = i.models(spark, sf)
    kept = registry.promote_models(models, i.newest_pending(models), AS_OF)
    return registry.live_recs(i.recommendations(spark, sf), kept)


@query(
    f"""SELECT {_REC_COLUMNS} FROM lineitem WHERE l_orderkey IN (
        SELECT id FROM promoted_models WHERE status = 'current' AND type = 'article' AND site = 'site-7')""",
    "promoted_models",
)
def served_recs(spark, sf):
    models = i.models(spark, sf)
    kept = registry.promote_models(models, i.newest_pending(models), AS_OF)
    return registry.served_recs(i.recommendations(spark, sf), kept, "article", "site-7")
