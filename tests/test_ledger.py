import json
from dataclasses import replace

import pytest
from conftest import rows
from test_job import ARTICLES, NOW, SITE, land_events, land_pages

from pressroom import schemas
from pressroom.plans import job
from pressroom.plans.ledger import Ledger
from pressroom.sources import files, tables


def test_a_stage_is_worked_off_once(spark, tmp_path):
    ledger, worked = Ledger(spark, str(tmp_path), "s", "r"), []

    def work():
        worked.append(1)
        return {"model": 7}

    assert ledger.once("a", work) == {"model": 7} and ledger.once("a", work) == {"model": 7} and len(worked) == 1
    assert ledger.once("b", lambda: None) == {} and ledger.finished() == ["a", "b"]
    assert Ledger(spark, str(tmp_path), "s", "other").facts("a") is None
    ledger.close()
    assert ledger.finished() == [] and ledger.once("a", work) and len(worked) == 2


def test_a_record_that_broke_off_is_none(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), "s", "r")
    files.write_text(spark, f"{ledger.path}/_a-1", json.dumps({"half": 1})[:4])
    assert ledger.facts("a") is None


@pytest.fixture()
def store(spark, tmp_path):
    land_events(tmp_path / "raw")
    land_pages(spark, str(tmp_path / "responses"))
    return job.Store(str(tmp_path / "raw"), str(tmp_path / "tables"), str(tmp_path / "responses"))


def test_a_run_goes_on_after_a_crash(spark, store, monkeypatch):
    """Killed within the third stage, and once more while the first recommendations are written."""

    def crash(*_, **__):
        raise RuntimeError("lost")

    for place, name in ((job, "_update_dwell"), (tables, "append_recs")):
        with monkeypatch.context() as patched:
            patched.setattr(place, name, crash)
            with pytest.raises(RuntimeError):
                job.run(spark, store, SITE, NOW, max_recs=3)
    again = replace(store, raw=store.raw + "-gone")  # nothing of the finished stages is read again
    job.run(spark, again, SITE, NOW, max_recs=3)

    metrics = spark.read.parquet(store.table("run_metrics"))
    assert rows(metrics.filter("name = 'job_time'").select("tags.status")) == [("failure",), ("failure",), ("success",)]
    assert metrics.filter("name in ('downloaded_rows', 'article_scraping_creates')").count() == 2
    models = tables.read_snapshot(spark, store.table("model"), schemas.MODELS)
    assert rows(models, "type", "status") == [("article", "current"), ("popularity", "current")]
    assert tables.read_recs(spark, store.table("recommendation")).count() == 4 + 3 * len(ARTICLES)
    assert not files.children(spark, f"{store.base}/ledger/site={SITE.name}")


def test_named_stages_only(spark, store):
    job.run(spark, store, SITE, NOW, stages=("events",))
    assert tables.read_events(spark, store.table("events")).count() == 98
    assert not files.exists(spark, store.table("dwelltimes")) and not files.exists(spark, store.table("model"))
