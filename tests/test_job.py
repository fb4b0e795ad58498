"""A whole run of one site on landed files, and the backfills."""

import gzip
import json
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pressroom import config, schemas
from pressroom.plans import job
from pressroom.sources import files, tables

SITE = replace(config.CITY_PAPER, training=config.TrainingParams(half_life=30.0, rank=4, iterations=2))
NOW = datetime(2021, 5, 10, 23, 30)
ARTICLES = range(100, 104)


def land_events(root):
    """Twelve readers who each spend a minute on all four articles, over the day."""
    for hour in (9, 15):
        lines = []
        for reader in range(12):
            for article in ARTICLES:
                for ping in range(6):
                    stamp = datetime(2021, 5, 10, hour, reader, ping * 10)
                    lines.append(
                        {
                            "collector_tstamp": stamp.isoformat() + "Z",
                            "domain_userid": f"r{reader}",
                            "event_name": "page_ping",
                            "page_urlpath": f"/article/{article}/slug",
                        }
                    )
        lines.append({**lines[0], "page_urlpath": "/food/x", "event_name": "page_view"})
        folder = root / SITE.name / f"2021/05/10/{hour:02d}"
        folder.mkdir(parents=True)
        text = "\n".join(map(json.dumps, lines)) + "\nnot json\n"
        (folder / "part.gz").write_bytes(gzip.compress(text.encode()))


def land_pages(spark, path):
    data = []
    for article in ARTICLES:
        body = (
            f'<meta property="article:published_time" content="2021-05-0{article - 99}T08:00:00+00:00">'
            f"<header><h1>Article {article}</h1></header>"
        )
        where = f"/article/{article}/slug"
        data.append((SITE.name, "page", where, None, "https://washingtoncitypaper.com" + where, 200, body, NOW))
    spark.createDataFrame(data, schemas.RESPONSES).write.parquet(path)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    land_events(root / "raw")
    land_pages(spark, str(root / "responses"))
    return job.Store(str(root / "raw"), str(root / "tables"), str(root / "responses"))


def test_run_twice(spark, store):
    before = set(files.children(spark, f"{spark.conf.get('spark.checkpoint.dir')}/settled"))
    for n in (1, 2):
        job.run(spark, store, SITE, NOW + timedelta(minutes=n), max_recs=3)

    events = tables.read_events(spark, store.table("events"))
    assert events.count() == 12 * 4 * 2 + 2
    assert rows(spark.read.parquet(store.table("rejected")), "reason") == [("malformed_json",)] * 2
    articles = tables.read_snapshot(spark, store.table("article"), schemas.ARTICLES)
    assert rows(articles, "external_id", "title") == [(str(a), f"Article {a}") for a in ARTICLES]
    cache = tables.read_snapshot(spark, store.table("path"), schemas.PATHS)
    assert rows(cache, "path", "exclude_reason")[-1] == ("/food/x", "no_external_id") and cache.count() == 5
    dwell = tables.read_dwell(spark, store.table("dwelltimes"))
    assert rows(dwell.select("duration").distinct()) == [(120,)] and dwell.count() == 48

    models = tables.read_snapshot(spark, store.table("model"), schemas.MODELS)
    assert rows(models, "type", "status") == [
        ("article", "current"), ("article", "stale"), ("popularity", "current"), ("popularity", "stale"),
    ]
    recs = tables.read_recs(spark, store.table("recommendation"))
    current = recs.join(models.filter("status = 'current'"), recs.model_id == models.id)
    default = current.filter("type = 'popularity'")
    # same dwell for all, so the youngest article leads
    best = default.filter("score = 1").first()["recommended_article_id"]
    assert default.count() == 4
    assert articles.filter(F.col("id") == best).first()["external_id"] == "103"
    assert rows(current.filter("type = 'article'").groupBy("source_entity_id").count()) == [
        (str(a), 3) for a in ARTICLES
    ]

    # nothing settled on the way is left behind
    settled = f"{spark.conf.get('spark.checkpoint.dir')}/settled"
    assert set(files.children(spark, settled)) == before

    metrics = spark.read.parquet(store.table("run_metrics"))
    first = {r["name"]: r["value"] for r in metrics.filter("run_id like '%T233100'").collect()}
    assert first["downloaded_rows"] == 2 * (12 * 4 * 6 + 2) and first["written_events"] == 98
    assert first["article_scraping_creates"] == 4 and first["rec_creation_total_article"] == 12
    assert metrics.filter("name = 'job_time' and tags['status'] = 'success'").count() == 2


def test_a_failed_run_is_recorded_and_raised(spark, store, tmp_path):
    broken = job.Store(store.raw, str(tmp_path / "tables"), str(tmp_path / "no-responses"))
    with pytest.raises(Exception):
        job.run(spark, broken, SITE, NOW)
    metrics = spark.read.parquet(broken.table("run_metrics"))
    assert rows(metrics.filter("name = 'job_time'").select("tags.status")) == [("failure",)]


def test_event_backfill_covers_the_range_in_one_go(spark, store, tmp_path):
    target = job.Store(store.raw, str(tmp_path / "tables"), store.responses)
    job.backfill_events(spark, target, SITE, datetime(2021, 5, 11), 3)
    assert tables.read_events(spark, target.table("events")).count() == 98
    assert tables.read_dwell(spark, target.table("dwelltimes")).count() == 48


def test_article_backfill(spark, tmp_path):
    site = config.TRIBUNE

    def listing(*items):
        body = json.dumps({"results": [
            {"headline": h, "pub_date": d + "T12:00:00-06:00", "url": f"https://x.org/{i}/?a", "id": i}
            for i, h, d in items
        ]})
        return (site.name, "bulk", None, None, "u", 200, body, NOW)

    data = [listing((1, "one", "2021-05-01"), (2, "two", "2021-05-02")), listing((3, "out", "2021-05-09"))]
    spark.createDataFrame(data, schemas.RESPONSES).write.parquet(str(tmp_path / "responses"))
    store = job.Store("", str(tmp_path / "tables"), str(tmp_path / "responses"))
    job.backfill_articles(spark, store, site, date(2021, 5, 1), 2, NOW)
    again = spark.createDataFrame([listing((2, "two, corrected", "2021-05-02"))], schemas.RESPONSES)
    again.write.mode("overwrite").parquet(str(tmp_path / "responses"))
    job.backfill_articles(spark, store, site, date(2021, 5, 1), 2, NOW + timedelta(days=1))
    found = tables.read_snapshot(spark, store.table("article"), schemas.ARTICLES)
    assert rows(found, "id", "external_id", "title", "path") == [
        (1, "1", "one", "/1/"), (2, "2", "two, corrected", "/2/"),
    ]
    assert rows(found, "updated_at") == [(NOW,), (NOW + timedelta(days=1),)]
    with pytest.raises(NotImplementedError):
        job.backfill_articles(spark, store, config.CITY_PAPER, date(2021, 5, 1), 2, NOW)
