from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pressroom import schemas
from pressroom.operators.metrics import RunMetrics
from pressroom.sources import files, tables


def events(spark, *items):
    data = [(c, None, date(2021, 3, 1), "/a", "page_ping", n, s, k) for c, n, s, k in items]
    return spark.createDataFrame(data, schemas.EVENTS)


def test_replace_chunks_is_idempotent_and_touches_only_its_chunks(spark, tmp_path):
    path = str(tmp_path / "events")
    tables.replace_chunks(events(spark, ("u", 1, "s", "2021/03/01/10"), ("u", 2, "s", "2021/03/01/11")), path)
    batch = events(spark, ("v", 5, "s", "2021/03/01/11"), ("w", 6, "t", "2021/03/01/10"))
    for _ in range(2):
        tables.replace_chunks(batch, path)
        found = rows(tables.read_events(spark, path), "client_id", "ping_count", "site", "chunk_name")
        assert found == [
            ("u", 1, "s", "2021/03/01/10"),
            ("v", 5, "s", "2021/03/01/11"),
            ("w", 6, "t", "2021/03/01/10"),
        ]


def dwell(spark, *items):
    data = [(n, "u", 1, "x", None, s, d) for n, s, d in items]
    return spark.createDataFrame(data, schemas.DWELL_TIMES)


def test_replace_dwell_clears_dates_that_became_empty(spark, tmp_path):
    path = str(tmp_path / "dwell")
    first, second = date(2021, 3, 1), date(2021, 3, 2)
    tables.replace_dwell(dwell(spark, (10, "s", first), (20, "s", second)), path, "s", [first, second])
    tables.replace_dwell(dwell(spark, (70, "t", first)), path, "t", [first])
    tables.replace_dwell(dwell(spark, (30, "s", second)), path, "s", [first, second])
    assert rows(tables.read_dwell(spark, path), "duration", "site") == [(30, "s"), (70, "t")]


def test_recs_of_a_model_are_written_once_and_dropped_with_it(spark, tmp_path):
    path = str(tmp_path / "recs")
    recs = spark.range(3).selectExpr(
        "'default' as source_entity_id", "id as recommended_article_id", "cast(0.5 as decimal(7,6)) as score"
    )
    for model_id in (1, 2, 2):
        tables.append_recs(recs, model_id, path)
    assert tables.read_recs(spark, path).count() == 6
    alive = spark.createDataFrame([(2,)], "id bigint")
    assert tables.drop_dead_recs(spark, path, alive) == ["model_id=1"]
    assert rows(tables.read_recs(spark, path), "model_id") == [(2,)] * 3


def test_snapshot_can_be_computed_from_itself(spark, tmp_path):
    path = str(tmp_path / "snap")
    assert tables.read_snapshot(spark, path, "n bigint").count() == 0
    tables.write_snapshot(spark.range(2).selectExpr("id as n"), path)
    for _ in range(4):
        current = tables.read_snapshot(spark, path, "n bigint")
        tables.write_snapshot(current.selectExpr("n + 10 as n"), path)
    assert rows(tables.read_snapshot(spark, path, "n bigint")) == [(40,), (41,)]
    assert sorted(files.children(spark, path)) == ["v=3", "v=4", "v=5"]


def test_unfinished_snapshot_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "snap")
    tables.write_snapshot(spark.range(1).selectExpr("id as n"), path)
    (tmp_path / "snap" / "v=2").mkdir()
    assert tables.read_snapshot(spark, path, "n bigint").count() == 1


def test_export(spark, tmp_path):
    target = tables.export_artifact(spark.range(2), str(tmp_path), "ids.csv")
    assert rows(spark.read.option("header", True).csv(target)) == [("0",), ("1",)]


def test_counts_are_taken_while_rows_are_written(spark, tmp_path):
    metrics = RunMetrics("run", site="s")
    rows_in = metrics.counted(spark.range(10), "rows", even=F.col("id") % 2 == 0)
    rows_in.write.parquet(str(tmp_path / "out"))
    metrics.add("time", 1.5, "Seconds", status="success")
    found = {r["name"]: r for r in metrics.frame(spark).collect()}
    assert found["rows"]["value"] == 10 and found["rows"]["tags"] == {"site": "s"}
    assert found["even"]["value"] == 5
    assert found["time"]["unit"] == "Seconds" and found["time"]["tags"]["status"] == "success"


def test_two_writers_of_one_version_lose_nothing(spark, tmp_path):
    path, schema = tables.of_site(str(tmp_path / "t"), "a"), "n bigint"
    tables.write_snapshot(spark.range(1).selectExpr("id as n"), path)
    seen = tables.latest_version(spark, path)
    slow = tables.read_version(spark, path, schema, seen).union(spark.sql("select 10L"))
    fast = tables.read_version(spark, path, schema, seen).union(spark.sql("select 20L"))
    tables.write_snapshot(fast, path, after=seen)
    with pytest.raises(tables.Conflict):
        tables.write_snapshot(slow, path, after=seen)
    assert rows(tables.read_snapshot(spark, str(tmp_path / "t"), schema, "a")) == [(0,), (20,)]
    assert not [n for n in files.children(spark, path) if n.startswith("_pending")]

    calls = []

    def change(now):
        if not calls:  # somebody else commits between reading and writing
            tables.write_snapshot(now.union(spark.sql("select 30L")), path)
        calls.append(1)
        return now.union(spark.sql("select 40L"))

    tables.update_snapshot(spark, path, schema, change)
    assert rows(tables.read_snapshot(spark, str(tmp_path / "t"), schema)) == [(0,), (20,), (30,), (40,)]
    assert len(calls) == 2


def test_sites_have_versions_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    for site, n in (("a", 1), ("b", 2), ("a", 3)):
        tables.write_snapshot(spark.sql(f"select '{site}' as site, {n}L as n"), tables.of_site(path, site))
    assert rows(tables.read_snapshot(spark, path, "site string, n bigint")) == [("a", 3), ("b", 2)]
    assert rows(tables.read_snapshot(spark, path, "site string, n bigint", "b")) == [("b", 2)]


def test_reserved_ids_never_meet(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [tables.reserve_ids(spark, path, n, block=10) for n in (3, 25, 1, 10)] == [1, 11, 41, 51]
    assert [tables.reserve_ids(spark, path + "2", 1, block=1) for _ in range(3)] == [1, 2, 3]
