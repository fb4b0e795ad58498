"""Stored tables: loads, replaced partitions, responses, published recommendations, metrics. Each query writes
under the checkpoint folder and reads back."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from checks import inputs as i
from checks.article_queries import PAGE_SIZE, tribune_bodies
from checks.duck import stamp
from checks.registry import query
from pressroom import config, schemas
from pressroom.operators import articles as art
from pressroom.operators import extraction
from pressroom.operators.metrics import RunMetrics
from pressroom.plans import ingest, job
from pressroom.session import checkpoint_dir, settle
from pressroom.sources import commits, files, responses, tables
from pressroom.streaming.ingest import stream_ingest

#: Lines land in the folder that ends their six hours, so up to six hours late.
SITE = replace(config.TRIBUNE, hours_of_data=6)


def _place(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/settled/{uuid.uuid4().hex}"


def _land(spark, sf: str, root: str) -> list[str]:
    """The event lines of ``inputs.event_lines`` as gzip files in hour folders. Articles with number 7 modulo 10 land two days
    late, beyond every load. Returns the hours from the first folder to the last."""
    moment = F.unix_seconds("collector_tstamp")
    lines = i.event_lines(spark, sf, keep=["n", "collector_tstamp"])
    folder = F.timestamp_seconds(F.floor(moment / 21600) * 21600 + 18000 + F.when(F.col("n") % 10 == 7, 172800).otherwise(0))
    landed = lines.withColumn("folder", F.date_format(folder, "yyyy-MM-dd-HH")).select("value", "folder")
    landed.repartition("folder").write.partitionBy("folder").option("compression", "gzip").text(f"{root}/_landing")
    names = []
    for name in files.children(spark, f"{root}/_landing"):
        if name.startswith("folder="):
            chunk = name.removeprefix("folder=").replace("-", "/")
            files.move(spark, f"{root}/_landing/{name}", f"{root}/{SITE.name}/{chunk}")
            names.append(chunk)
    first, last = (datetime.strptime(f(names), "%Y/%m/%d/%H") for f in (min, max))
    hours = int((last - first).total_seconds() // 3600)
    return [(first + timedelta(hours=h)).strftime("%Y/%m/%d/%H") for h in range(-6, hours + 1)]


_USABLE = """(SELECT CASE WHEN n % 10 <> 2 THEN domain_userid END AS client_id, t AS activity_time,
       CAST(t AS DATE) AS session_date, page_urlpath AS landing_page_path, event_name, strftime(t, '%Y/%m/%d/%H') AS chunk_name
    FROM (SELECT *, make_timestamp(CAST(round_even(CAST(epoch_us(collector_tstamp) AS DECIMAL(20,0)) / 1000000, 0)
                    AS BIGINT) * 1000000) AS t FROM raw_events WHERE n % 10 NOT IN (0, 1, 7)))"""
_LOADED = f"""
    SELECT client_id, {stamp('min(activity_time)')} AS activity_time, landing_page_path, event_name, count(*) AS ping_count, chunk_name
    FROM {_USABLE} WHERE event_name = 'page_ping' AND client_id IS NOT NULL
    GROUP BY client_id, session_date, landing_page_path, event_name, chunk_name
    UNION ALL
    SELECT client_id, {stamp('activity_time')}, landing_page_path, event_name, NULL, chunk_name FROM {_USABLE} WHERE event_name <> 'page_ping'
"""
_COLUMNS = ["client_id", "activity_time", "landing_page_path", "event_name", "ping_count", "chunk_name"]


def _load(spark, sf: str, metrics: RunMetrics | None = None) -> str:
    """Three overlapping loads, and one of an hour for which nothing landed."""
    base = _place(spark)
    hours = _land(spark, sf, f"{base}/raw")
    third = len(hours) // 3
    windows = [hours[: third + 30], hours[third : 2 * third + 30], hours[2 * third :], ["1999/01/01/00"]]
    for number, names in enumerate(windows):
        seen = metrics if number == len(windows) - 1 else None
        ingest.ingest_events(spark, f"{base}/raw", f"{base}/events", SITE, names, f"{base}/rejected", seen, manifest_path=f"{base}/hours")
    return base


@query(_LOADED, "raw_events")
def ingest_hours(spark, sf):
    """Late and rounded lines, loaded in overlapping windows, give the same table as all events at once."""
    return tables.read_events(spark, f"{_load(spark, sf)}/events").select(*_COLUMNS)


@query(
    """
    SELECT CASE n % 10 WHEN 0 THEN 'missing_field' WHEN 1 THEN 'malformed_json' ELSE 'outside_horizon' END AS reason, count(*) AS n_lines
    FROM raw_events WHERE n % 10 IN (0, 1, 7) GROUP BY ALL
    """,
    "raw_events",
)
def rejected_hours(spark, sf):
    """Unusable and too late lines, each kept once however often its folder was loaded."""
    rejected = spark.read.parquet(f"{_load(spark, sf)}/rejected")
    return rejected.groupBy("reason").agg(F.count("value").alias("n_lines"))


@query(_LOADED, "raw_events")
def stream_ingested(spark, sf):
    """The same from the stream form."""
    base = _place(spark)
    _land(spark, sf, f"{base}/raw")
    stream_ingest(spark, f"{base}/raw", f"{base}/events", f"{base}/progress", SITE, rejected_path=f"{base}/rejected").awaitTermination()
    return tables.read_events(spark, f"{base}/events").select(*_COLUMNS)


@query(_LOADED, "raw_events")
def suffixless_hours(spark, sf):
    """Landed gzip files that lost their suffix give the same events."""
    base = _place(spark)
    hours = _land(spark, sf, f"{base}/raw")
    for name, _ in files.all_files(spark, f"{base}/raw"):
        files.move(spark, name, name.removesuffix(".txt.gz"))
    ingest.ingest_events(spark, f"{base}/raw", f"{base}/events", SITE, hours, f"{base}/rejected", gzip_without_suffix=True)
    return tables.read_events(spark, f"{base}/events").select(*_COLUMNS)


_DAY = [f"2024/01/15/{h:02d}" for h in range(24)]


@query(
    f"""
    SELECT * FROM (WITH f AS (
        SELECT CAST(floor(epoch(collector_tstamp) / 21600) * 21600 AS BIGINT) + 18000 + CASE WHEN n % 10 = 7 THEN 172800 ELSE 0 END AS folder,
            CAST(round_even(CAST(epoch_us(collector_tstamp) AS DECIMAL(20,0)) / 1000000, 0) AS BIGINT) // 3600 * 3600 AS hour, n % 10 NOT IN (0, 1, 7) AS usable
        FROM raw_events),
    named AS (SELECT DISTINCT folder FROM f WHERE make_timestamp(folder * 1000000)::DATE = DATE '2024-01-15'),
    touched AS (
        SELECT 1705276800 + 3600 * unnest(range(24)) AS hour UNION SELECT hour FROM f WHERE usable AND folder IN (FROM named)),
    holding AS (SELECT folder FROM named UNION SELECT folder FROM f WHERE usable AND hour IN (FROM touched)),
    reachable AS (SELECT folder FROM named UNION SELECT f.folder FROM f JOIN touched t ON f.folder BETWEEN t.hour - 3600 AND t.hour + 21600),
    written AS (SELECT count(*) AS n FROM ({_LOADED}) WHERE epoch(strptime(chunk_name, '%Y/%m/%d/%H')) IN (FROM touched))
    SELECT 'with manifest' AS load, (SELECT count(*) FROM holding) AS read_folders, (SELECT n FROM written) AS written_events
    UNION ALL SELECT 'without manifest', (SELECT count(*) FROM reachable), (SELECT n FROM written))
    """,
    "raw_events",
)
def late_hours(spark, sf):
    """One day loaded again after the days around it: with the hour manifest only folders with lines of its hours are read, without it all that could have
    some. What is written is the same."""
    base = _place(spark)
    around = [h for h in _land(spark, sf, f"{base}/raw") if "2024/01/13" <= h[:10] <= "2024/01/17"]
    ingest.ingest_events(spark, f"{base}/raw", f"{base}/events", SITE, around, manifest_path=f"{base}/hours")
    rows = []
    for name, place in (("with manifest", f"{base}/hours"), ("without manifest", None)):
        metrics = RunMetrics(name)
        ingest.ingest_events(spark, f"{base}/raw", f"{base}/events", SITE, _DAY, metrics=metrics, manifest_path=place)
        counts = {r[1]: int(r[2]) for r in metrics.rows()}
        rows.append((name, counts["read_folders"], counts["written_events"]))
    return spark.createDataFrame(rows, "load string, read_folders long, written_events long")


@query(
    f"""
    SELECT 'downloaded_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM raw_events
    UNION ALL SELECT 'rejected_rows', CAST(count(*) FILTER (WHERE n % 10 IN (0, 1, 7)) AS DOUBLE) FROM raw_events
    UNION ALL SELECT 'written_events', CAST(count(*) AS DOUBLE) FROM ({_LOADED})
    UNION ALL SELECT 'empty_downloaded_rows', 0
    """,
    "raw_events",
)
def run_metrics(spark, sf):
    """Counts taken while one load was written, and those of a load for which nothing landed."""
    base = _place(spark)
    hours = _land(spark, sf, f"{base}/raw")
    full, empty = RunMetrics("full"), RunMetrics("empty")
    ingest.ingest_events(spark, f"{base}/raw", f"{base}/events", SITE, hours, f"{base}/rejected", full)
    ingest.ingest_events(spark, f"{base}/raw", f"{base}/events", SITE, ["1999/01/01/00"], f"{base}/rejected", empty)
    full.frame(spark).filter("name <> 'read_folders'").write.parquet(f"{base}/metrics")
    empty.frame(spark).filter("name = 'downloaded_rows'").withColumn("name", F.concat(F.lit("empty_"), "name")).write.mode("append").parquet(f"{base}/metrics")
    return spark.read.schema(schemas.RUN_METRICS).parquet(f"{base}/metrics").select("name", "value")


@query(
    """
    SELECT duration, client_id, article_id, external_id, site, CAST(session_date AS VARCHAR) AS session_date
    FROM event_dwell WHERE site = 'site-1' AND session_date <> DATE '2024-01-02'
    """,
    "event_dwell",
)
def refresh_dwell(spark, sf):
    """Dwell times of one site in two refreshes; the events of one date are gone by the second, and so are its dwell times."""
    base = _place(spark)
    stored, articles = i.stored_events(spark, sf), i.articles(spark, sf)
    tables.replace_chunks(stored, f"{base}/events")
    days = [row[0] for row in stored.select("session_date").distinct().collect()]
    ingest.refresh_dwell(spark, f"{base}/events", f"{base}/dwell", articles, "site-1", days)
    left = settle(tables.read_events(spark, f"{base}/events").filter("session_date <> DATE '2024-01-02'"))
    tables.replace_chunks(left, f"{base}/events_left")
    ingest.refresh_dwell(spark, f"{base}/events_left", f"{base}/dwell", articles, "site-1", days)
    return tables.read_dwell(spark, f"{base}/dwell").drop("published_at")


@query(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS source_entity_id, ps AS recommended_article_id, model, status FROM (
        SELECT s_suppkey, s_nationkey AS ps, 2 AS model, 'stale' AS status FROM supplier
        UNION ALL SELECT s_suppkey, s_nationkey + 1, 3, 'current' FROM supplier)
    """
)
def publish_recs(spark, sf):
    """Recommendations published three times: the newest model is current, the one before stale, and a repeated write
    of a model leaves nothing twice."""
    store = job.Store("", _place(spark), "")
    suppliers = i.read(spark, sf, "supplier")
    for number in range(3):
        recs = suppliers.select(
            F.col("s_suppkey").cast("string").alias("source_entity_id"),
            (F.col("s_nationkey") + number - 1).cast("bigint").alias("recommended_article_id"),
            F.lit(0.5).cast("decimal(7,6)").alias("score"),
        )
        model = job.publish(spark, store, recs, "popularity", "site-0", datetime(2024, 1, 1 + 30 * (number > 0), number), RunMetrics("x"))
    tables.append_recs(recs, model, store.table("recommendation"))
    models = tables.read_snapshot(spark, store.table("model"), schemas.MODELS)
    found = tables.read_recs(spark, store.table("recommendation")).join(models.select("id", "status"), F.col("model_id") == F.col("id"))
    return found.filter("model_id > 1").select("source_entity_id", "recommended_article_id", F.col("model_id").cast("int").alias("model"), "status")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def export_artifact(spark, sf):
    """A result as CSV, read back with its header."""
    target = tables.export_artifact(i.read(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), _place(spark), "suppliers")
    return spark.read.option("header", True).csv(target)


def _landed_responses(spark, sf):
    """Every page as a response for a path; of each third page an older copy with another body landed too."""
    pages = i.read(spark, sf, "pages")
    body = F.when(F.col("page_id") % 13 == 5, F.concat("html", F.lit("<![foo[bar]]>"))).otherwise(F.col("html"))
    fetched = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") % 5 * 86400)
    rows = pages.select(
        i.site_of(F.col("page_id")).alias("site"),
        F.lit("page").alias("kind"),
        i.article_path(F.col("page_id")).alias("path"),
        F.lit(None).cast("string").alias("external_id"),
        "url",
        F.lit(200).alias("status"),
        body.alias("body"),
        fetched.alias("fetched_at"),
    )
    older = rows.filter(F.length("path") % 3 == 0).withColumn("body", F.lit("old")).withColumn("fetched_at", F.expr("fetched_at - INTERVAL 2 DAYS"))
    return rows.unionByName(older)


@query(
    """
    SELECT '/article/' || CAST(page_id + 100 AS VARCHAR) || '/slug-' || CAST(page_id AS VARCHAR) AS path, url,
           CASE WHEN page_id % 13 = 5 THEN length(html) + 13 ELSE length(html) END AS n_chars
    FROM pages WHERE page_id % 3 = 1 AND page_id % 5 >= 2
    """
)
def read_responses(spark, sf):
    """The newest responses of one site, fetched since a day, out of folders by site, kind and day."""
    path = f"{_place(spark)}/responses"
    responses.write_responses(_landed_responses(spark, sf), path)
    found = responses.read_responses(spark, path, "site-1", kinds=["page"], since=date(2024, 1, 3))
    newest = extraction.latest_responses(found, "page", "path")
    return newest.select("path", "url", F.length("body").cast("long").alias("n_chars"))


@query(
    """
    SELECT '/article/' || CAST(page_id + 100 AS VARCHAR) || '/slug-' || CAST(page_id AS VARCHAR) AS path,
           CASE WHEN page_id % 13 = 5 THEN 'malformed_api_response'
                WHEN page_id % 7 = 2 THEN 'failed_site_validation' END AS error_type,
           CASE WHEN page_id % 13 <> 5 AND page_id % 7 <> 2 AND page_id % 4 <> 0 THEN '2024-02-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') || ' 06:30:00' END AS published_at
    FROM pages
    """
)
def html_metadata(spark, sf):
    """Whole pages with a title, most with a publish time, some with the exclude tag, some damaged."""
    n = F.col("page_id")
    time = F.concat(F.lit('<meta property="article:published_time" content="2024-02-'), F.lpad((1 + n % 28).cast("string"), 2, "0"), F.lit('T08:30:00+02:00">'))
    tag = F.lit('<div id="primary"><p class="tag-exclude">x</p></div>')
    empty = F.lit("")
    body = F.concat(
        F.when(n % 4 != 0, time).otherwise(empty),
        F.lit("<header><h1>Title</h1></header>"),
        F.when(n % 7 == 2, tag).otherwise(empty),
        "html",
        F.when(n % 13 == 5, F.lit("<![foo[bar]]>")).otherwise(empty),
    )
    pages = i.read(spark, sf, "pages").select(
        i.site_of(n).alias("site"), i.article_path(n).alias("path"), F.lit(None).cast("string").alias("external_id"),
        F.concat(F.lit("https://example.org"), i.article_path(n)).alias("url"), F.lit(200).alias("status"), body.alias("body"),
    )
    found = extraction.metadata_from_html(pages)
    shown = F.when(F.col("error_type").isNull(), F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))
    return found.select("path", "error_type", shown.alias("published_at"))


@query(
    """
    SELECT * FROM (WITH now AS (SELECT * FROM articles WHERE site = 'site-1'),
    new AS (SELECT external_id, 'changed ' || external_id AS title FROM now WHERE (id - 1) % 60 = 1 UNION ALL SELECT 'n' || CAST(unnest([1, 2]) AS VARCHAR), 'new')
    SELECT coalesce(n.external_id, a.external_id) AS external_id, coalesce(n.title, a.title) AS title, TRUE AS few_rewritten, TRUE AS rest_untouched
    FROM now a FULL JOIN new n ON n.external_id = a.external_id)
    """,
    "articles",
)
def bucket_upsert(spark, sf):
    """Changes to a few stored articles: only the buckets they fall in are written again, the other files stay the same ones."""
    base = _place(spark)
    group = commits.metadata_group(base)
    now = i.articles(spark, sf).filter("site = 'site-1'")
    start = commits.newest(spark, group, "site-1", buckets=64)
    first = commits.write(spark, group, "site-1", start, {"article": (commits.touched(group, "article", start, now), now)})
    wanted = now.filter("(id - 1) % 60 = 1").select("site", "external_id", F.concat(F.lit("changed "), "external_id").alias("title"), "path", "published_at")
    added = spark.sql("SELECT 'site-1' AS site, concat('n', n) AS external_id, 'new' AS title, '/n' AS path, TIMESTAMP '2024-01-01' AS published_at FROM VALUES (1), (2) AS t(n)")
    changes = settle(wanted.unionByName(added))
    buckets = commits.touched(group, "article", first, changes)
    part = commits.read(spark, group, "site-1", "article", first, buckets)
    upserted = art.upsert_articles(part, changes, i.EVENT_DAY, 1_000_000)
    second = commits.write(spark, group, "site-1", first, {"article": (buckets, upserted)})
    kept = all(second.files["article"][b] == f for b, f in first.files["article"].items() if b not in buckets)
    few = len(buckets) <= changes.count()
    rows = commits.read(spark, group, "site-1", "article", second)
    return rows.select("external_id", "title", F.lit(few).alias("few_rewritten"), F.lit(kept).alias("rest_untouched"))


def _pages(numbers, site: str):
    """A page for each article number: every fourth without a publish time, every seventh with the exclude tag."""
    n = F.col("id")
    time = F.lit('<meta property="article:published_time" content="2024-02-01T08:30:00+02:00">')
    tag = F.lit('<div id="primary"><p class="tag-exclude">x</p></div>')
    body = F.concat(
        F.when(n % 4 != 0, time).otherwise(F.lit("")), F.lit("<header><h1>Title "), n.cast("string"), F.lit("</h1></header>"), F.when(n % 7 == 2, tag).otherwise(F.lit(""))
    )
    return numbers.select(
        F.lit(site).alias("site"), F.lit("page").alias("kind"), i.article_path(n).alias("path"), F.lit(None).cast("string").alias("external_id"),
        F.concat(F.lit("https://example.org"), i.article_path(n)).alias("url"), F.lit(200).alias("status"), body.alias("body"), F.lit(datetime(2024, 1, 15)).alias("fetched_at"),
    )


_METADATA_SITE = replace(config.CITY_PAPER, name="site-1")


@query(
    """
    SELECT * FROM (WITH art AS (SELECT * FROM articles WHERE site = 'site-1' AND (id - 1) % 10 <> 4),
    cache AS (SELECT * FROM paths WHERE site = 'site-1'),
    seen AS (SELECT DISTINCT landing_page_path AS path, CAST(regexp_extract(landing_page_path, '/article/([0-9]+)/', 1) AS BIGINT) - 100 AS n FROM events_agg WHERE site = 'site-1'),
    wanted AS (
        SELECT s.path, s.n, c.external_id FROM seen s LEFT JOIN cache c USING (path) LEFT JOIN art a ON a.external_id = c.external_id
        WHERE c.exclude_reason IS NULL AND (c.external_id IS NULL OR a.published_at IS NULL OR a.published_at > TIMESTAMP '2024-01-14')),
    fresh AS (SELECT path, n, CAST(100 + n AS VARCHAR) AS external_id FROM wanted WHERE external_id IS NULL),
    again AS (SELECT DISTINCT a.path, CAST(a.external_id AS BIGINT) - 100 AS n, a.external_id FROM wanted w JOIN art a ON a.external_id = w.external_id),
    judged AS (
        SELECT *, CASE WHEN n % 7 = 2 THEN 'failed_site_validation' WHEN n % 4 = 0 THEN 'no_publish_date' END AS error
        FROM (SELECT path, n, external_id, TRUE AS is_new FROM fresh WHERE external_id NOT IN (SELECT external_id FROM art)
              UNION ALL SELECT path, n, external_id, FALSE FROM again)),
    duplicates AS (SELECT * FROM fresh WHERE external_id IN (SELECT external_id FROM art)),
    added AS (
        SELECT path, external_id, CAST(NULL AS VARCHAR) AS reason FROM judged WHERE error IS NULL AND is_new
        UNION ALL SELECT path, external_id, NULL FROM duplicates
        UNION ALL SELECT path, NULL, error FROM judged WHERE error = 'failed_site_validation'),
    gone AS (SELECT external_id FROM judged WHERE NOT is_new AND (error IS NULL OR error = 'failed_site_validation'))
    SELECT 'article' AS kind, external_id AS key, 'Title ' || CAST(n AS VARCHAR) AS value, '2024-02-01 06:30:00' AS more FROM judged WHERE error IS NULL
    UNION ALL SELECT 'article', external_id, title, strftime(published_at, '%Y-%m-%d %H:%M:%S') FROM art WHERE external_id NOT IN (SELECT external_id FROM gone)
    UNION ALL SELECT 'path', path, external_id, reason FROM added
    UNION ALL SELECT 'path', path, external_id, exclude_reason FROM cache WHERE path NOT IN (SELECT path FROM added)
    UNION ALL SELECT 'error', path, error, NULL FROM judged WHERE error IS NOT NULL
    UNION ALL SELECT 'error', path, 'duplicate_path', NULL FROM duplicates)
    """,
    "events_agg articles paths",
)
def update_metadata(spark, sf):
    """One run's metadata update on stored tables: articles, path cache and errors afterwards."""
    base = _place(spark)
    store = job.Store("", base, f"{base}/responses")
    tables.replace_chunks(i.stored_events(spark, sf).filter("site = 'site-1'"), store.table("events"))
    group = commits.metadata_group(base)
    start = commits.newest(spark, group, "site-1", buckets=16)
    known = i.articles(spark, sf).filter("site = 'site-1' AND (id - 1) % 10 <> 4")
    stored = {"article": known, "path": i.paths(spark, sf).filter("site = 'site-1'")}
    commits.write(spark, group, "site-1", start, {name: (list(range(16)), rows) for name, rows in stored.items()})
    responses.write_responses(_pages(spark.range(1, 1000, 3), "site-1"), store.responses)
    hours = [(datetime(2024, 1, 31) - timedelta(hours=h)).strftime("%Y/%m/%d/%H") for h in range(24 * 31 + 1)]
    errors = job._update_metadata(spark, store, _METADATA_SITE, hours, datetime(2024, 1, 15, 12), RunMetrics("x")).errors
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    articles = tables.read_snapshot(spark, store.table("article"), schemas.ARTICLES, "site-1")
    cache = tables.read_snapshot(spark, store.table("path"), schemas.PATHS, "site-1")
    found = articles.select(F.lit("article").alias("kind"), F.col("external_id").alias("key"), F.col("title").alias("value"), text("published_at").alias("more"))
    found = found.unionByName(cache.select(F.lit("path").alias("kind"), F.col("path").alias("key"), F.col("external_id").alias("value"), F.col("exclude_reason").alias("more")))
    return found.unionByName(errors.select(F.lit("error").alias("kind"), F.col("path").alias("key"), F.col("error_type").alias("value"), F.lit(None).cast("string").alias("more")))


_DAY_SITE = replace(config.CITY_PAPER, name=SITE.name)


@query(
    f"""
    SELECT * FROM (WITH f AS (
        SELECT n, page_urlpath, event_name, CAST(floor(epoch(collector_tstamp) / 21600) * 21600 AS BIGINT) + 18000 + CASE WHEN n % 10 = 7 THEN 172800 ELSE 0 END AS folder,
            CAST(round_even(CAST(epoch_us(collector_tstamp) AS DECIMAL(20,0)) / 1000000, 0) AS BIGINT) // 3600 * 3600 AS hour, n % 10 NOT IN (0, 1, 7) AS usable
        FROM raw_events),
    named AS (SELECT * FROM f WHERE folder // 86400 = 1705276800 // 86400),
    touched AS (SELECT 1705276800 + 3600 * unnest(range(24)) AS hour UNION SELECT hour FROM named WHERE usable),
    day AS (SELECT * FROM f WHERE usable AND hour // 86400 = 1705276800 // 86400),
    good AS (SELECT DISTINCT n, page_urlpath FROM day WHERE n % 7 <> 2 AND n % 4 <> 0 AND (n % 10 <> 2 OR event_name <> 'page_ping'))
    SELECT 'downloaded_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM named
    UNION ALL SELECT 'rejected_rows', count(*) FILTER (WHERE NOT usable) FROM named
    UNION ALL SELECT 'written_events', count(*) FROM ({_LOADED}) WHERE epoch(strptime(chunk_name, '%Y/%m/%d/%H')) IN (FROM touched)
    UNION ALL SELECT 'article_scraping_creates', count(*) FROM good
    UNION ALL SELECT 'rec_creation_total_popularity', least(50, count(DISTINCT n)) FROM day JOIN good USING (n) WHERE event_name = 'page_ping' AND n % 10 <> 2)
    """,
    "raw_events",
)
def run_counts_of_job(spark, sf):
    """The counts of a scheduled run over landed files and responses that broke off before its last stage and was called again: no stage is counted twice."""
    base = _place(spark)
    _land(spark, sf, f"{base}/raw")
    responses.write_responses(_pages(spark.range(1000), SITE.name), f"{base}/responses")
    store, now = job.Store(f"{base}/raw", base, f"{base}/responses"), datetime(2024, 1, 15, 23, 30)
    publish = job.publish
    job.publish = lambda *_: 1 / 0
    try:
        job.run(spark, store, _DAY_SITE, now, stages=job.STAGES[:-1])
    except ZeroDivisionError:
        pass
    finally:
        job.publish = publish
    job.run(spark, store, _DAY_SITE, now, stages=job.STAGES[:-1])
    names = ["downloaded_rows", "rejected_rows", "written_events", "article_scraping_creates", "rec_creation_total_popularity"]
    found = spark.read.schema(schemas.RUN_METRICS).parquet(store.table("run_metrics"))
    return found.filter(F.col("name").isin(names)).select("name", "value")


@query(
    f"""
    SELECT * FROM (WITH good AS (SELECT DISTINCT landing_page_path AS path, n FROM (
            SELECT landing_page_path, CAST(regexp_extract(landing_page_path, '/article/([0-9]+)/', 1) AS BIGINT) - 100 AS n
            FROM {_USABLE} WHERE event_name <> 'page_ping' OR client_id IS NOT NULL)
        WHERE n % 7 <> 2 AND n % 4 <> 0)
    SELECT client_id, CAST(100 + n AS VARCHAR) AS external_id, CAST(session_date AS VARCHAR) AS session_date, 10 * count(*) AS duration
    FROM {_USABLE} u JOIN good ON path = landing_page_path WHERE event_name = 'page_ping' AND client_id IS NOT NULL
    GROUP BY client_id, n, session_date)
    """,
    "raw_events",
)
def backfill_events(spark, sf):
    """Dwell times after a backfill over all landed days that broke off before its dwell times and was called again."""
    base = _place(spark)
    last = datetime.strptime(max(_land(spark, sf, f"{base}/raw")), "%Y/%m/%d/%H")
    responses.write_responses(_pages(spark.range(1000), SITE.name), f"{base}/responses")
    store = job.Store(f"{base}/raw", base, f"{base}/responses")
    refresh = ingest.refresh_dwell
    ingest.refresh_dwell = lambda *_: 1 / 0
    try:
        job.backfill_events(spark, store, _DAY_SITE, last, 40)
    except ZeroDivisionError:
        pass
    finally:
        ingest.refresh_dwell = refresh
    job.backfill_events(spark, store, _DAY_SITE, last, 40)
    return tables.read_dwell(spark, store.table("dwelltimes")).select("client_id", "external_id", "session_date", "duration")


@query(
    """
    SELECT * FROM (WITH listed AS (
        SELECT CAST(doc_id AS VARCHAR) AS external_id, md5(text) AS title, DATE '2024-01-01' + CAST(doc_id % 90 AS INT) + INTERVAL '18 hours 45 minutes 35 seconds' AS published,
            '/article/' || CAST(100 + doc_id AS VARCHAR) || '/slug-' || CAST(doc_id AS VARCHAR) AS path
        FROM documents WHERE doc_id % 3 = 1 AND doc_id % 17 <> 0 AND doc_id % 13 <> 0),
    loaded AS (SELECT * FROM listed WHERE published >= TIMESTAMP '2024-01-10' AND published < TIMESTAMP '2024-02-20'),
    before AS (SELECT CAST(doc_id AS VARCHAR) AS external_id, md5('before') AS title, TIMESTAMP '2023-12-01 00:00:00' AS published, '/before' AS path FROM documents WHERE doc_id % 6 = 1)
    SELECT external_id, title, strftime(published, '%Y-%m-%d %H:%M:%S') AS published_at, path, external_id IN (SELECT external_id FROM before) AS was_there
    FROM (FROM loaded UNION ALL FROM before WHERE external_id NOT IN (SELECT external_id FROM loaded)))
    """
)
def backfill_articles(spark, sf):
    """Articles of a site after a backfill from listings over some weeks: half of the site's articles were there before with another title, and keep their ids."""
    base = _place(spark)
    store = job.Store("", base, f"{base}/responses")
    site = replace(config.TRIBUNE, name="site-1")
    n, landed = F.col("doc_id"), F.lit(datetime(2024, 3, 1))
    bodies = tribune_bodies(spark, sf).filter("site = 'site-1'")
    pages = bodies.groupBy(F.floor(n / PAGE_SIZE).alias("page")).agg(F.array_join(F.collect_list("body"), ",").alias("items"))
    text = F.lit(None).cast("string")
    listings = pages.select(
        F.lit("site-1").alias("site"), F.lit("bulk").alias("kind"), text.alias("path"), text.alias("external_id"), F.lit("u").alias("url"),
        F.lit(200).alias("status"), F.concat(F.lit('{"results":['), "items", F.lit("]}")).alias("body"), landed.alias("fetched_at"),
    )
    responses.write_responses(listings, store.responses)
    old = datetime(2023, 12, 1)
    before = i.read(spark, sf, "documents").filter(n % 6 == 1).select(
        (n + 1).alias("id"), F.lit("site-1").alias("site"), n.cast("string").alias("external_id"), F.lit("before").alias("title"), F.lit("/before").alias("path"),
        F.lit(old).alias("published_at"), F.lit(old).alias("created_at"), F.lit(old).alias("updated_at"),
    )
    group = commits.metadata_group(base)
    commits.write(spark, group, "site-1", commits.newest(spark, group, "site-1", buckets=16), {"article": (list(range(16)), before)})
    tables.reserve_ids(spark, store.table("article"), before.agg(F.max("id")).first()[0])
    job.backfill_articles(spark, store, site, date(2024, 1, 10), 41, datetime(2024, 3, 1))
    found = tables.read_snapshot(spark, store.table("article"), schemas.ARTICLES, "site-1")
    was_there = F.col("id") == F.col("external_id").cast("long") + 1
    return found.select("external_id", F.md5("title").alias("title"), "published_at", "path", was_there.alias("was_there"))


def _shouted(rows):
    """A metadata rule of one's own: the length of the page's body as title, and a date by number."""
    number = F.col("external_id").cast("long")
    return rows.select(
        "*",
        F.length("body").cast("string").alias("title"),
        F.timestamp_seconds(F.lit(1704067200) + number * 60).alias("published_at"),
        F.col("path").alias("new_path"),
        F.col("external_id").alias("new_external_id"),
        F.when(F.col("body").isNull(), "fetch_error").alias("error_type"),
        F.lit(None).cast("string").alias("msg"),
    )


_OWN_SITE = config.SiteConfig(
    name="own",
    domain="example.org",
    hours_of_data=1,
    popularity_window=1,
    max_article_age=1,
    training=config.TrainingParams(),
    id_rule=(lambda paths, _: paths, lambda paths: extraction.id_from_path(paths, "^/own/([0-9]+)", 1)),
    metadata_rule=(extraction.METADATA_RULES["article_html"][0], _shouted),
    bulk_rule=lambda listed, start, end: listed.select("path", F.length("body").alias("n_chars")).filter(F.col("n_chars").between(start, end)),
    validators=(("url LIKE '%/fr/%'", "French"), ("length(body) % 5 = 0", "Divisible")),
)


@query(
    """
    SELECT * FROM (WITH own AS (
        SELECT page_id, '/own/' || CAST(page_id AS VARCHAR) AS path, CAST(page_id AS VARCHAR) AS external_id,
            CASE WHEN page_id % 11 <> 3 THEN html END AS body, page_id % 7 <> 5 AS landed,
            page_id % 7 <> 5 AND page_id % 11 <> 3 AND page_id % 6 <> 0 AS fetched, url LIKE '%/fr/%' AS french
        FROM pages)
    SELECT 'article' AS kind, path, CASE WHEN landed THEN CAST(length(body) AS VARCHAR) END AS title,
        strftime(make_timestamp((1704067200 + page_id * 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS published_at,
        CASE WHEN fetched AND (french OR length(body) % 5 = 0) THEN 'failed_site_validation' WHEN NOT landed OR body IS NULL THEN 'fetch_error' END AS error_type,
        CASE WHEN fetched AND french THEN 'French' WHEN fetched AND length(body) % 5 = 0 THEN 'Divisible' END AS msg
    FROM own
    UNION ALL SELECT 'listed', path, CAST(length(html) AS VARCHAR), NULL, NULL, NULL FROM own JOIN pages USING (page_id) WHERE length(html) BETWEEN 500 AND 1500)
    """
)
def site_rules(spark, sf):
    """A newsroom of one's own: rules for ids, metadata and listings as functions, and validators in SQL, the first of which that holds counts."""
    n = F.col("page_id")
    pages = i.read(spark, sf, "pages").select(n, F.concat(F.lit("/own/"), n.cast("string")).alias("path"), "url", "html")
    no_id = F.lit(None).cast("string").alias("external_id")
    responses_of = lambda rows, kind, status, body: rows.select(
        F.lit("own").alias("site"), F.lit(kind).alias("kind"), "path", no_id, "url", status.alias("status"), body.alias("body"), F.lit(datetime(2024, 1, 15)).alias("fetched_at")
    )
    landed = responses_of(pages.filter(n % 7 != 5), "page", F.when(n % 6 == 0, 404).otherwise(200), F.when(n % 11 != 3, F.col("html")))
    landed = settle(landed.unionByName(responses_of(pages, "bulk", F.lit(200), F.col("html"))))
    ids = extraction.extract_ids(_OWN_SITE, pages.select(F.lit("own").alias("site"), "path"), landed)
    found = extraction.extract_metadata(_OWN_SITE, ids, landed)
    shown = found.select(F.lit("article").alias("kind"), "path", "title", "published_at", "error_type", "msg")
    listed = extraction.bulk_articles(_OWN_SITE, landed, 500, 1500).select(F.lit("listed").alias("kind"), "path", F.col("n_chars").cast("string").alias("title"))
    return shown.unionByName(listed, allowMissingColumns=True)
