import gzip
import json
from datetime import datetime

from conftest import rows

from pressroom import config
from pressroom.operators import events
from pressroom.plans.ingest import ingest_events
from pressroom.sources import tables
from pressroom.streaming.ingest import hourly_pings_stream, stream_ingest

SITE = config.TRIBUNE


def land(root, folder, name, *events_):
    target = root / SITE.name / folder
    target.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps({"collector_tstamp": t, "domain_userid": u, "event_name": e, "page_urlpath": "/a"})
        for t, u, e in events_
    ]
    (target / f"{name}.gz").write_bytes(gzip.compress(("\n".join(lines) + "\n").encode()))


def run(spark, tmp_path, **options):
    query = stream_ingest(
        spark, str(tmp_path / "raw"), str(tmp_path / "streamed"), str(tmp_path / "progress"), SITE, **options
    )
    assert query.awaitTermination(120)
    found = tables.read_events(spark, str(tmp_path / "streamed"))
    return rows(found, "chunk_name", "client_id", "event_name", "ping_count", "activity_time")


def batch(spark, tmp_path, names):
    path = str(tmp_path / "batch")
    ingest_events(spark, str(tmp_path / "raw"), path, SITE, names)
    found = tables.read_events(spark, path)
    return rows(found, "chunk_name", "client_id", "event_name", "ping_count", "activity_time")


HOURS = [f"2021/03/01/{h:02d}" for h in range(9, 14)]


def test_stream_equals_batch_and_late_lines_reopen_their_chunk(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, HOURS[1], "a", ("2021-03-01T10:10:00Z", "u", "page_ping"), ("2021-03-01T10:59:59.7Z", "u", "page_ping"))
    land(raw, HOURS[2], "b", ("2021-03-01T11:10:00Z", "u", "page_ping"), ("2021-03-01T11:11:00Z", "v", "page_view"))
    first = run(spark, tmp_path)
    assert first == batch(spark, tmp_path, HOURS)
    assert run(spark, tmp_path) == first  # nothing new, nothing changes

    # one more file for a loaded hour, and a line that landed an hour after it happened
    land(raw, HOURS[1], "late", ("2021-03-01T10:05:00Z", "u", "page_ping"))
    land(raw, HOURS[2], "later", ("2021-03-01T10:20:00Z", "w", "page_ping"))
    second = run(spark, tmp_path)
    assert second == batch(spark, tmp_path, HOURS)
    counts = {(r[0], r[1]): r[3] for r in second if r[2] == "page_ping"}
    assert counts[HOURS[1], "u"] == 2 and counts[HOURS[1], "w"] == 1 and counts[HOURS[2], "u"] == 2


def test_too_late_is_ignored(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, HOURS[1], "a", ("2021-03-01T10:10:00Z", "u", "page_ping"))
    first = run(spark, tmp_path)
    land(raw, HOURS[1], "late", ("2021-03-01T10:20:00Z", "u", "page_ping"))
    assert run(spark, tmp_path, oldest_chunk=HOURS[2]) == first


def test_small_batches_give_the_same_table(spark, tmp_path):
    raw = tmp_path / "raw"
    for n in range(4):
        land(raw, HOURS[1 + n % 2], f"f{n}", (f"2021-03-01T1{n % 2}:1{n}:00Z", "u", "page_ping"))
    assert run(spark, tmp_path, max_files=1) == batch(spark, tmp_path, HOURS)


def test_hours_close_behind_the_watermark(spark, tmp_path):
    schema = "site string, activity_time timestamp, event_name string"
    source = tmp_path / "normalised"

    def arrive(name, *times):
        data = [("s", datetime(2021, 3, 1, *t), "page_ping") for t in times]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(source))

    def drain():
        stream = spark.readStream.schema(schema).parquet(str(source))
        query = (
            hourly_pings_stream(stream, 2)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "marks"))
            .option("path", str(tmp_path / "hours"))
            .trigger(availableNow=True)
            .start()
        )
        assert query.awaitTermination(120)
        return rows(spark.read.parquet(str(tmp_path / "hours")), "chunk_name", "pings")

    arrive("1", (8, 10), (8, 20), (9, 0))
    drain()
    arrive("2", (8, 30))  # late but inside two hours
    drain()
    arrive("3", (13, 0))
    drain()
    arrive("4", (8, 40))  # its hour is final
    assert drain() == [(HOURS[0].replace("09", "08"), 3), (HOURS[0], 1)]
    batch_form = events.hourly_pings(spark.read.schema(schema).parquet(str(source)))
    assert ("2021/03/01/13", 1) in rows(batch_form, "chunk_name", "pings")
