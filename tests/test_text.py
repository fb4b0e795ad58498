from datetime import datetime
from urllib.parse import urlparse

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pressroom.functions import text, vectors

URLS = [
    "https://example.org/food/article/1/x?page=2#top",
    "https://example.org",
    "http://user@example.org:80/a;p=1?q",
    "/article/1/x",
    "/article/1/with blank/",
    "/a:b/c",
    "//host/path",
    "relative/path?x=/y",
    "",
    "mailto:a",
]


def test_url_path_agrees_with_the_standard_library(spark):
    found = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", text.url_path(F.col("u")))
    assert {r[0]: r[1] for r in found.collect()} == {u: urlparse(u).path for u in URLS}


def column_of(spark, expression, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in frame.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_publish_dates(spark):
    texts = ["2022-03-04T05:06:07Z", "2022-03-04T05:06:07.891Z", "2022-03-04T05:06:07.891", "x", None]
    whole, part = datetime(2022, 3, 4, 5, 6, 7), datetime(2022, 3, 4, 5, 6, 7, 891000)
    assert column_of(spark, text.parse_publish_date, *texts) == [whole, part, None, None, None]
    strict = column_of(spark, lambda c: text.parse_publish_date(c, True), *texts)
    assert strict == [None, part, None, None, None]


def test_offsets_become_utc(spark):
    found = column_of(spark, text.to_utc, "2022-03-04T11:22:33-06:00", "2022-03-04T05:06:07+00:00", "never")
    assert found == [datetime(2022, 3, 4, 17, 22, 33), datetime(2022, 3, 4, 5, 6, 7), None]


@pytest.mark.parametrize(
    "meta, expected", [("Meta", "Meta"), ("", "Basic"), (None, "Basic")]
)
def test_headline_prefers_a_filled_search_title(spark, meta, expected):
    frame = spark.createDataFrame([(meta, "Basic")], "m string, b string")
    assert rows(frame.select(text.headline(F.col("m"), F.col("b")))) == [(expected,)]


def test_small_texts(spark):
    assert column_of(spark, text.strip_leading_zeros, "00123", "0", "000", "10") == ["123", "0", "0", "10"]
    assert column_of(spark, text.strip_query_suffix, "/a.html&cid=1&x", "/a") == ["/a.html", "/a"]


def test_scores_and_vectors(spark):
    frame = spark.sql("select 0.1234565D s, array(3.0f, 4.0f) v, array(0.0f, 0.0f) z")
    out = frame.select(
        vectors.score_decimal(F.col("s")).cast("string"),
        vectors.l2_normalise(F.col("v")),
        vectors.l2_normalise(F.col("z")),
        vectors.unit_similarity(vectors.cosine(F.col("v"), F.col("v"))),
        vectors.unit_similarity(vectors.cosine(F.col("v"), F.col("z"))),
    )
    assert rows(out) == [("0.123457", [0.6, 0.8], [0.0, 0.0], 1.0, 0.0)]
