import gzip
import json

import pytest
from conftest import rows

from pressroom import config
from pressroom.operators.metrics import RunMetrics
from pressroom.plans import ingest
from pressroom.sources import hours, tables
from pressroom.streaming.ingest import stream_ingest

SITE = config.TRIBUNE.__class__(**{**config.TRIBUNE.__dict__, "hours_of_data": 24})


def land(root, folder, name, *times):
    target = root / "raw" / SITE.name / folder
    target.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps({"collector_tstamp": t, "domain_userid": "u", "event_name": "page_view", "page_urlpath": "/a"}) for t in times]
    (target / f"{name}.gz").write_bytes(gzip.compress(("\n".join(lines) + "\n").encode()))


def load(spark, root, *names, manifest=True):
    metrics = RunMetrics("x")
    place = str(root / "hours") if manifest else None
    ingest.ingest_events(spark, str(root / "raw"), str(root / "events"), SITE, list(names), metrics=metrics, manifest_path=place)
    return {r[1]: r[2] for r in metrics.rows()}


def table(spark, root):
    return rows(tables.read_events(spark, str(root / "events")), "chunk_name", "activity_time")


DAY = [f"2021/03/01/{h:02d}" for h in range(24)]


def test_an_hour_is_read_from_the_folders_that_hold_it(spark, tmp_path):
    for h in range(12):
        land(tmp_path, DAY[h], "a", f"2021-03-01T{h:02d}:10:00Z")
    land(tmp_path, DAY[9], "late", "2021-03-01T03:20:00Z")
    load(spark, tmp_path, *DAY)
    first = table(spark, tmp_path)
    # hour 3 has lines in folders 3 and 9; folder 9 isn't named and read for it, nothing else is
    assert load(spark, tmp_path, DAY[3]) == {"downloaded_rows": 1, "rejected_rows": 0, "written_events": 2, "read_folders": 2}
    assert load(spark, tmp_path, DAY[3], manifest=False)["read_folders"] == 10
    assert table(spark, tmp_path) == first and len(first) == 13


def test_folders_that_are_new_or_have_grown_are_read(spark, tmp_path):
    for h in range(4):
        land(tmp_path, DAY[h], "a", f"2021-03-01T{h:02d}:10:00Z")
    load(spark, tmp_path, *DAY[:4])
    land(tmp_path, DAY[2], "b", "2021-03-01T00:30:00Z")
    land(tmp_path, DAY[20], "c", "2021-03-01T00:40:00Z")
    counts = load(spark, tmp_path, DAY[0])
    assert counts["read_folders"] == 3 and counts["written_events"] == 3
    # neither was loaded itself, so both are still read next time
    assert load(spark, tmp_path, DAY[0])["read_folders"] == 3
    noted = hours.known(spark, str(tmp_path / "hours"), SITE.name, DAY)
    assert sorted(noted) == DAY[:4] and noted[DAY[2]].lines == {DAY[2]: 1}


def test_a_folder_without_usable_lines_is_noted(spark, tmp_path):
    land(tmp_path, DAY[0], "a", "no time", "2020-01-01T00:00:00Z")
    assert load(spark, tmp_path, DAY[0])["rejected_rows"] == 2
    noted = hours.known(spark, str(tmp_path / "hours"), SITE.name, DAY)
    assert list(noted) == [DAY[0]] and noted[DAY[0]].lines == {} and noted[DAY[0]].size[1] == 1
    assert load(spark, tmp_path, DAY[1])["read_folders"] == 0


def stream(spark, root):
    assert stream_ingest(spark, str(root / "raw"), str(root / "events"), str(root / "progress"), SITE, metrics=(m := RunMetrics("s"))).awaitTermination(120)
    return {r[1]: r[2] for r in m.rows()}


def test_the_stream_opens_only_hours_that_changed(spark, tmp_path):
    for h in range(4):
        land(tmp_path, DAY[h], "a", f"2021-03-01T{h:02d}:10:00Z")
    assert stream(spark, tmp_path)["written_events"] == 4
    land(tmp_path, DAY[3], "b", "2021-03-01T01:30:00Z")
    counts = stream(spark, tmp_path)
    assert counts["written_events"] == 2 and counts["read_folders"] == 2  # hour 1, from folders 3 and 1
    assert len(table(spark, tmp_path)) == 5


@pytest.mark.parametrize("crash_at", ["replace_chunks", "replace_rejected"])
def test_a_load_that_breaks_off_is_made_again(spark, tmp_path, monkeypatch, crash_at):
    land(tmp_path, DAY[0], "a", "2021-03-01T00:10:00Z")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, crash_at, crash)
        with pytest.raises(RuntimeError):
            source = ingest.Source(str(tmp_path / "raw"), str(tmp_path / "events"), str(tmp_path / "bad"), str(tmp_path / "hours"))
            ingest.load_folders(spark, source, SITE, DAY[:1])
    assert hours.known(spark, str(tmp_path / "hours"), SITE.name, DAY) == {}
    wanted, _ = ingest.load_folders(spark, source, SITE, DAY[:1])
    assert wanted == {DAY[0]} and len(table(spark, tmp_path)) == 1
    assert ingest.load_folders(spark, source, SITE, DAY[:1])[0] == set()


def test_long_ranges_in_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "HOURS_AT_ONCE", 2)
    for h in range(6):
        land(tmp_path, DAY[h], "a", f"2021-03-01T{h:02d}:10:00Z", f"2021-03-01T{max(h - 2, 0):02d}:50:00Z")
    assert load(spark, tmp_path, *DAY[:6])["written_events"] == 12
    assert len(table(spark, tmp_path)) == 12
