import json
from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from pressroom.functions import clock
from pressroom.operators import events
from pressroom.plans import ingest


def lines(spark, *texts):
    return spark.createDataFrame([(t, "s") for t in texts], "value string, site string")


def line(**changes):
    record = {
        "collector_tstamp": "2021-03-01T10:00:00.2Z",
        "domain_userid": "u",
        "event_name": "page_ping",
        "page_urlpath": "/a",
        "other": {"deep": [1]},
    }
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v is not ...})


def test_missing_key_is_dropped_null_value_is_kept(spark):
    batch = lines(spark, line(), line(domain_userid=None), line(page_urlpath=...))
    assert rows(events.parse_events(batch), "domain_userid", "page_urlpath") == [("u", "/a"), (None, "/a")]


def test_bad_lines_are_quarantined_with_a_reason(spark):
    whole = line(page_urlpath="/z")
    batch = lines(spark, line(), line(event_name=...), whole[:-3], "", "[1]", "null", None)
    found = rows(events.quarantine_events(batch), "reason")
    assert found == [("malformed_json",)] * 5 + [("missing_field",)]
    assert events.parse_events(batch).count() == 1


def test_cut_line_with_all_fields_present_is_malformed(spark):
    text = line().replace('"other"', '"other2"')
    batch = lines(spark, text[: text.index('"other2"')])
    assert rows(events.quarantine_events(batch), "reason") == [("malformed_json",)]


def test_rounding_goes_to_the_even_second_and_may_change_the_day(spark):
    batch = spark.createDataFrame(
        [("2021-03-01 10:00:00.5",), ("2021-03-01 10:00:01.5",), ("2021-03-01 23:59:59.6",), ("1969-12-31 23:59:58.5",)],
        "t string",
    )
    rounded = clock.round_second(F.col("t").cast("timestamp"))
    found = rows(batch.select(rounded.alias("r")))
    assert found == sorted(
        [
            (datetime(2021, 3, 1, 10, 0, 0),),
            (datetime(2021, 3, 1, 10, 0, 2),),
            (datetime(2021, 3, 2, 0, 0, 0),),
            (datetime(1969, 12, 31, 23, 59, 58),),
        ],
        key=repr,
    )


def test_normalise_renames_and_derives(spark):
    raw = events.parse_events(lines(spark, line(collector_tstamp="2021-03-01T23:59:59.7Z")))
    (row,) = events.normalise_events(raw).collect()
    assert row["client_id"] == "u" and row["landing_page_path"] == "/a"
    assert row["session_date"] == date(2021, 3, 2) and row["chunk_name"] == "2021/03/02/00"


def test_pings_group_inside_their_chunk_and_others_pass_through(spark):
    batch = lines(
        spark,
        line(collector_tstamp="2021-03-01T10:00:10Z"),
        line(collector_tstamp="2021-03-01T10:00:00Z"),
        line(collector_tstamp="2021-03-01T11:00:00Z"),
        line(domain_userid=None),
        line(event_name="page_view"),
        line(event_name="page_view"),
        line(event_name=None, domain_userid=None),
    )
    stored = ingest.events_from_lines(batch)
    assert rows(stored, "event_name", "chunk_name", "ping_count") == sorted(
        [
            (None, "2021/03/01/10", None),
            ("page_ping", "2021/03/01/10", 2),
            ("page_ping", "2021/03/01/11", 1),
            ("page_view", "2021/03/01/10", None),
            ("page_view", "2021/03/01/10", None),
        ],
        key=repr,
    )
    first = stored.filter("ping_count = 2").first()
    assert first["activity_time"] == datetime(2021, 3, 1, 10, 0, 0)


def test_unreadable_time_is_rejected_not_lost(spark):
    batch = lines(spark, line(), line(collector_tstamp="soon"), line(page_urlpath=...))
    assert ingest.events_from_lines(batch).count() == 1
    assert rows(ingest.judge(batch).filter("reason IS NOT NULL"), "reason") == [("bad_timestamp",), ("missing_field",)]


def test_half_life(spark):
    batch = spark.createDataFrame([(date(2021, 3, 1),), (date(2021, 3, 21),)], "d date")
    decay = clock.half_life_decay(date(2021, 3, 11), F.col("d"), 10)
    assert rows(batch.select(decay)) == [(0.5,), (2.0,)]


def test_half_life_of_moments_floors_the_days(spark):
    batch = spark.createDataFrame([("2021-03-01 12:00:01",), ("2021-03-01 12:00:00",)], "d string")
    days = clock.whole_days_between("2021-03-01 12:00:00", F.col("d").cast("timestamp"), False)
    assert rows(batch.select(days)) == [(-1,), (0,)]
