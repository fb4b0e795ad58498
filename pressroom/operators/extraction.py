"""Landed responses -> external ids and article metadata.

Rules take rows that already carry their response (``url``, ``status``, ``body``) and add
the extracted columns plus ``error_type``/``msg``, which are NULL for a good row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom import config
from pressroom.functions import computed_once, text
from pressroom.operators.html import page_facts
from pressroom.operators.skew import lookup_join


def first_error(rules: list[tuple[Column, str]]) -> Column:
    """Message of the first rule that holds, NULL when none does."""
    found = [F.when(broken, F.lit(message)) for broken, message in rules]
    return F.coalesce(*found, F.lit(None).cast("string"))


def fetched() -> Column:
    """True when a usable response was landed for the row."""
    return F.col("body").isNotNull() & F.coalesce(F.col("status") < 400, F.lit(True))


def _with_errors(df: DataFrame, chain: list[tuple[Column, str, str]]) -> DataFrame:
    """``chain`` is (condition, failure type, message); the first that holds wins."""
    error, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, failure, words in reversed(chain):
        holds = F.coalesce(condition, F.lit(False))
        error = F.when(holds, F.lit(failure)).otherwise(error)
        message = F.when(holds, F.lit(words)).otherwise(message)
    return df.withColumn("error_type", error).withColumn("msg", message)


def latest_responses(responses: DataFrame, kind: str, key: str) -> DataFrame:
    """The most recent response per site and ``key`` column; of several from the same moment the one with the
    largest url and body hash. Bodies are neither compared nor kept while the newest is looked for: that is a partial
    maximum over narrow columns, and the one body is fetched afterwards."""
    rows = responses.filter((F.col("kind") == kind) & F.col(key).isNotNull()).withColumn("_h", F.xxhash64("body"))
    newest = rows.groupBy("site", key).agg(F.max(F.struct("fetched_at", "url", "_h", "status")).alias("_r"))
    newest = newest.select(F.col("site").alias("_site"), F.col(key).alias("_key"), "_r")
    same = (F.col("site") == F.col("_site")) & (F.col(key) == F.col("_key"))
    for column in ("fetched_at", "url", "_h", "status"):
        same = same & F.col(column).eqNullSafe(F.col(f"_r.{column}"))
    found = rows.join(newest, same).select("site", key, "url", "status", "body")
    return found.dropDuplicates(["site", key])


# ------------------------------------------------------------------ external ids


def id_from_path(
    df: DataFrame, pattern: str = config.ARTICLE_PATH_PATTERN, group: int = 3, path: str = "path"
) -> DataFrame:
    """The id is in the path itself; no response is needed."""
    found = F.nullif(F.regexp_extract(F.col(path), pattern, group), F.lit(""))
    out = _with_errors(
        df.withColumn("external_id", found),
        [(F.col("external_id").isNull(), "no_external_id", "External ID not found in path")],
    )
    return out


def id_from_html(df: DataFrame, prefixes=config.NON_ARTICLE_PREFIXES, path: str = "path") -> DataFrame:
    """First ``contentID: '<digits>'`` of the page, without leading zeros."""
    digits = F.nullif(F.regexp_extract("body", r"contentID: '([0-9]+)'", 1), F.lit(""))
    found = df.withColumn("external_id", text.strip_leading_zeros(digits))
    skipped = text.starts_with_any(F.col(path), prefixes)
    out = _with_errors(
        found,
        [
            (skipped, "no_external_id", "Path is not an article"),
            (~fetched(), "fetch_error", "Page was not fetched"),
            (F.col("external_id").isNull(), "no_external_id", "External ID not found"),
        ],
    )
    return out.withColumn("external_id", F.when(F.col("error_type").isNull(), F.col("external_id")))


ARC_LOOKUP = "_id string, source struct<system:string>, taxonomy struct<sites:array<struct<_id:string>>>"


def id_from_api_json(df: DataFrame, prefixes=config.INVALID_PREFIXES, path: str = "path") -> DataFrame:
    """Content API lookup by path: an id, made in-house, not on the test site.

    A rejected article keeps its id next to the error, as far as it is known.
    """
    body = F.col("body")
    parsed = computed_once(df, _j=F.from_json(body, ARC_LOOKUP), _k=F.json_object_keys(body))
    in_house = F.col("_j.source.system").isin(*config.IN_HOUSE_PLATFORMS)
    first_site = F.get(F.col("_j.taxonomy.sites"), F.lit(0))["_id"]
    skipped = text.starts_with_any(text.strip_query_suffix(F.col(path)), prefixes)
    out = _with_errors(
        parsed,
        [
            (skipped, "failed_site_validation", "Path has an invalid prefix"),
            (~fetched() | F.col("_k").isNull(), "fetch_error", "Content lookup failed"),
            (F.col("_j._id").isNull(), "no_external_id", "External ID not in response"),
            (F.coalesce(~in_house, F.lit(True)), "failed_site_validation", "Not an in-house article"),
            (first_site == config.TEST_SITE, "failed_site_validation", "Test article"),
        ],
    )
    known = F.when(
        F.col("error_type").isNull() | F.col("msg").isin("Not an in-house article", "Test article"),
        F.col("_j._id"),
    )
    return out.withColumn("external_id", known).drop("_j", "_k")


# ---------------------------------------------------------------- article metadata
# every rule adds: title, published_at, new_path, new_external_id, error_type, msg


def metadata_from_html(df: DataFrame, title_path: tuple[str, ...] = ("header", "h1")) -> DataFrame:
    """Title, publish time and canonical path of an article page."""
    rows = computed_once(df, _f=page_facts(F.col("body"), *title_path))
    out = _with_errors(
        rows,
        [
            (~fetched(), "fetch_error", "Page was not fetched"),
            (F.col("_f.excluded"), "failed_site_validation", config.EXCLUDE_TAG_MESSAGE),
            (F.col("_f.title").isNull(), "malformed_api_response", "No title on the page"),
        ],
    )
    return (
        out.withColumn("title", F.col("_f.title"))
        .withColumn("published_at", text.to_utc(F.col("_f.published")))
        .withColumn("new_path", text.url_path(F.col("url")))
        .withColumn("new_external_id", F.col("external_id"))
        .drop("_f")
    )


TRIBUNE_ARTICLE = "headline string, pub_date string, url string, id string"


def _tribune_columns(rows: DataFrame) -> DataFrame:
    body = F.col("body")
    rows = computed_once(rows, _j=F.from_json(body, TRIBUNE_ARTICLE), _k=F.json_object_keys(body))
    keys = F.col("_k")
    missing = text.lacks_json_keys(keys, "headline", "pub_date", "url", "id")
    shaped = (
        rows.withColumn("title", F.col("_j.headline"))
        .withColumn("published_at", text.to_utc(F.col("_j.pub_date")))
        .withColumn("new_path", text.url_path(F.col("_j.url")))
        .withColumn("new_external_id", F.col("_j.id"))
    )
    return _with_errors(
        shaped,
        [
            (~fetched() | keys.isNull(), "fetch_error", "Response is not JSON"),
            (missing, "malformed_api_response", "Article field missing"),
        ],
    ).drop("_j", "_k")


def metadata_from_tribune_json(df: DataFrame) -> DataFrame:
    return _tribune_columns(df)


ARC_ARTICLE = (
    "headlines struct<meta_title:string,basic:string>, publish_date string, _id string, canonical_url string"
)


def arc_rules(item: str, strict_dates: bool = False) -> list[tuple[Column, str]]:
    """What an article payload must have, in the order it is checked."""
    date = text.parse_publish_date(F.col(f"{item}.publish_date"), strict_dates)
    return [
        (F.col(f"{item}.headlines.basic").isNull(), "Article missing headline"),
        (F.col(f"{item}.canonical_url").isNull(), "Article canonical URL missing"),
        (F.col(f"{item}.publish_date").isNull(), "Article publish date missing"),
        (date.isNull(), "Cannot parse date of publication"),
    ]


def validate(df: DataFrame, rules: list[tuple[Column, str]], message: str = "msg") -> DataFrame:
    return df.withColumn(message, first_error(rules))


def _arc_columns(rows: DataFrame, strict_dates: bool, parsed: Column) -> DataFrame:
    broken = first_error(arc_rules("_j", strict_dates))
    failure = (
        F.when(~fetched(), F.lit("fetch_error"))
        .when(~parsed | broken.isNotNull(), F.lit("malformed_api_response"))
        .when(F.col("_j._id").isNull(), F.lit("fetch_error"))
    )
    words = (
        F.when(~fetched(), F.lit("Article was not fetched"))
        .when(~parsed, F.lit("Cannot parse article response JSON"))
        .when(broken.isNotNull(), broken)
        .when(F.col("_j._id").isNull(), F.lit("Error parsing external_id"))
    )
    return (
        rows.withColumn(
            "title", text.headline(F.col("_j.headlines.meta_title"), F.col("_j.headlines.basic"))
        )
        .withColumn("published_at", text.parse_publish_date(F.col("_j.publish_date")))
        .withColumn("new_path", F.col("_j.canonical_url"))
        .withColumn("new_external_id", F.col("_j._id"))
        .withColumn("error_type", failure)
        .withColumn("msg", words)
    )


def metadata_from_arc_json(df: DataFrame, strict_dates: bool = False) -> DataFrame:
    body = F.col("body")
    rows = computed_once(df, _j=F.from_json(body, ARC_ARTICLE), _k=F.json_object_keys(body))
    return _arc_columns(rows, strict_dates, F.col("_k").isNotNull()).drop("_j", "_k")


# ------------------------------------------------------------------- bulk responses

BULK_COLUMNS = ["site", "external_id", "title", "path", "published_at", "error_type", "msg"]


def _bulk(rows: DataFrame, start, end) -> DataFrame:
    out = rows.withColumn("external_id", F.col("new_external_id")).withColumn("path", F.col("new_path"))
    published = F.col("published_at")
    in_range = (published >= F.lit(start).cast("timestamp")) & (published < F.lit(end).cast("timestamp"))
    return out.filter(in_range | F.col("error_type").isNotNull()).select(*BULK_COLUMNS)


def bulk_from_tribune(responses: DataFrame, start, end) -> DataFrame:
    """Articles of ``results[]`` published in ``[start, end)``, and items with errors."""
    listed = F.from_json("body", "results array<string>")["results"]
    rows = responses.select("site", "status", F.explode(listed).alias("body"))
    return _bulk(_tribune_columns(rows), start, end)


def bulk_from_arc(responses: DataFrame, start, end) -> DataFrame:
    """Articles of ``content_elements[]`` published in ``[start, end)``, and items with errors."""
    listed = F.from_json("body", f"content_elements array<struct<{_as_fields(ARC_ARTICLE)}>>")
    rows = responses.select("site", "status", "body", F.explode(listed["content_elements"]).alias("_j"))
    return _bulk(_arc_columns(rows, False, F.lit(True)), start, end)


def _as_fields(schema: str) -> str:
    """``a string, b string`` -> ``a:string,b:string`` as a struct type wants it."""
    return ",".join(part.strip().replace(" ", ":", 1) for part in schema.split(", "))


# ------------------------------------------------------------------------ dispatch


def _no_response(df: DataFrame, responses: DataFrame) -> DataFrame:
    return df


def _with_response(df: DataFrame, responses: DataFrame, kind: str, key: str) -> DataFrame:
    """Attach each row's response. Responses nobody asked for are dropped first, so only
    wanted bodies are shuffled."""
    keys = ["site", key]
    wanted = lookup_join(responses, df.select(*keys).distinct(), keys, "left_semi")
    return df.join(latest_responses(wanted, kind, key), keys, "left")


def _page_by_path(df: DataFrame, responses: DataFrame) -> DataFrame:
    return _with_response(df, responses, "page", "path")


def _article_by_id(df: DataFrame, responses: DataFrame) -> DataFrame:
    return _with_response(df, responses, "article", "external_id")


# name -> (how a row gets its response, what is read from it)
ID_RULES = {
    "article_path": (_no_response, id_from_path),
    "html_content_id": (_page_by_path, id_from_html),
    "arc_lookup": (_page_by_path, id_from_api_json),
}
METADATA_RULES = {
    "article_html": (_page_by_path, metadata_from_html),
    "tribune_json": (_article_by_id, metadata_from_tribune_json),
    "arc_json": (_article_by_id, metadata_from_arc_json),
}
BULK_RULES = {"tribune_bulk": bulk_from_tribune, "arc_bulk": bulk_from_arc}


def _chosen(rules: dict, rule):
    return rules[rule] if isinstance(rule, str) else rule


def extract_ids(site: config.SiteConfig, paths: DataFrame, responses: DataFrame) -> DataFrame:
    """``(site, path)`` -> ``(site, path, external_id, error_type, msg)``."""
    attach, rule = _chosen(ID_RULES, site.id_rule)
    return rule(attach(paths.select("site", "path"), responses)).select(
        "site", "path", "external_id", "error_type", "msg"
    )


def _site_validation(df: DataFrame, validators) -> DataFrame:
    """A response that was fetched but breaks a rule of its site is rejected, whatever else
    is wrong with it."""
    broken = first_error([(F.expr(predicate), message) for predicate, message in validators])
    rejected = fetched() & broken.isNotNull()
    return df.withColumn("msg", F.when(rejected, broken).otherwise(F.col("msg"))).withColumn(
        "error_type", F.when(rejected, F.lit("failed_site_validation")).otherwise(F.col("error_type"))
    )


def extract_metadata(site: config.SiteConfig, articles: DataFrame, responses: DataFrame) -> DataFrame:
    """``(site, path, external_id)`` -> the same plus what the article's response says."""
    attach, rule = _chosen(METADATA_RULES, site.metadata_rule)
    found = rule(attach(articles.select("site", "path", "external_id"), responses))
    return _site_validation(found, site.validators).select(
        "site",
        "path",
        "external_id",
        "title",
        "published_at",
        "new_path",
        "new_external_id",
        "error_type",
        "msg",
    )


def bulk_articles(site: config.SiteConfig, responses: DataFrame, start, end) -> DataFrame:
    """Listed articles published in ``[start, end)``, and items with errors."""
    if site.bulk_rule is None:
        raise NotImplementedError(f"{site.name} has no bulk listing")
    listed = responses.filter((F.col("site") == site.name) & (F.col("kind") == "bulk"))
    return _chosen(BULK_RULES, site.bulk_rule)(listed, start, end)
