import json

from conftest import rows
from pyspark.sql import functions as F

from pressroom import config, schemas
from pressroom.operators import extraction


def bodies(spark, *items):
    """(path, status, body) rows"""
    return spark.createDataFrame(
        [(p, None, f"https://h{p}?q", s, b) for p, s, b in items],
        "path string, external_id string, url string, status int, body string",
    )


def test_first_error_wins(spark):
    good, bad = (F.lit(False), "never"), (F.lit(True), "first")
    frame = spark.range(1)
    cases = [[good], [bad], [good, good], [good, bad], [bad, (F.lit(True), "second")], []]
    found = [extraction.validate(frame, rules).first()["msg"] for rules in cases]
    assert found == [None, "first", None, "first", "first", None]


def test_ids_in_paths(spark):
    paths = spark.createDataFrame(
        [
            ("/v/s/washingtoncitypaper.com/article/700404/a-list/",),
            ("/c/s/washingtoncitypaper.com/article/7/x",),
            ("/v/s/washingtoncitypaperXcom/article/8/x",),
            ("/article/700101/some-slug/",),
            ("/article/700101/",),
            ("/x/article/5/y",),
            ("/food/x",),
        ],
        "path string",
    )
    found = {r["path"]: (r["external_id"], r["error_type"]) for r in extraction.id_from_path(paths).collect()}
    missing = (None, "no_external_id")
    assert list(found.values()) == [
        ("700404", None), ("7", None), missing, ("700101", None), missing, missing, missing,
    ]


def test_ids_in_pages(spark):
    page = "<script>a = {contentID: '00123', contentID: '9'}</script>"
    found = extraction.id_from_html(
        bodies(
            spark,
            ("/2021/x", 200, page),
            ("/about/x", 200, page),
            ("/2021/y", 200, "<p>contentID: 'x'</p>"),
            ("/2021/z", 404, page),
            ("/2021/w", None, None),
            ("/2021/0", 200, "contentID: '000'"),
        )
    )
    assert rows(found, "path", "external_id", "error_type") == [
        ("/2021/0", "0", None),
        ("/2021/w", None, "fetch_error"),
        ("/2021/x", "123", None),
        ("/2021/y", None, "no_external_id"),
        ("/2021/z", None, "fetch_error"),
        ("/about/x", None, "no_external_id"),
    ]


def lookup(**changes):
    answer = {"_id": "A", "source": {"system": "composer"}, "taxonomy": {"sites": [{"_id": "/news"}]}}
    answer.update(changes)
    return json.dumps({k: v for k, v in answer.items() if v is not ...})


def test_ids_from_the_content_api(spark):
    found = extraction.id_from_api_json(
        bodies(
            spark,
            ("/1", 200, lookup()),
            ("/2", 200, lookup(_id=...)),
            ("/3", 200, lookup(source={"system": "wires"})),
            ("/4", 200, lookup(source=...)),
            ("/5", 200, lookup(taxonomy={"sites": [{"_id": "/zzz-systest"}, {"_id": "/news"}]})),
            ("/6", 200, lookup(taxonomy=...)),
            ("/7", 200, lookup(taxonomy={"sites": []})),
            ("/8", 200, "<html>"),
            ("/9", 500, lookup()),
            ("/author/x", 200, lookup()),
            ("/zzz-systest/x", 200, lookup()),
        )
    )
    assert rows(found, "path", "external_id", "error_type") == [
        ("/1", "A", None),
        ("/2", None, "no_external_id"),
        ("/3", "A", "failed_site_validation"),
        ("/4", "A", "failed_site_validation"),
        ("/5", "A", "failed_site_validation"),
        ("/6", "A", None),
        ("/7", "A", None),
        ("/8", None, "fetch_error"),
        ("/9", None, "fetch_error"),
        ("/author/x", None, "failed_site_validation"),
        ("/zzz-systest/x", None, "failed_site_validation"),
    ]


def test_page_metadata(spark):
    meta = '<meta property="article:published_time" content="2022-03-04T05:06:07-01:00">'
    found = extraction.metadata_from_html(
        bodies(
            spark,
            ("/1", 200, meta + "<header><h1> T </h1></header>"),
            ("/2", 200, "<header><h1>T</h1></header>"),
            ("/3", 200, meta),
            ("/4", 200, '<div id="primary"><p class="tag-exclude"></p></div>' + meta),
            ("/5", 503, meta),
        )
    )
    shown = found.withColumn("published_at", F.col("published_at").cast("string"))
    assert rows(shown, "new_path", "title", "published_at", "error_type", "msg")[:2] == [
        ("/1", "T", "2022-03-04 06:06:07", None, None),
        ("/2", "T", None, None, None),
    ]
    assert rows(found, "path", "error_type")[2:] == [
        ("/3", "malformed_api_response"),
        ("/4", "failed_site_validation"),
        ("/5", "fetch_error"),
    ]
    assert found.filter("path = '/4'").first()["msg"] == config.EXCLUDE_TAG_MESSAGE


ARC = {
    "headlines": {"meta_title": "Meta", "basic": "Basic"},
    "publish_date": "2022-03-01T06:12:31.457Z",
    "_id": "TCK",
    "canonical_url": "/news/x.html",
}


def test_arc_metadata(spark):
    def payload(**changes):
        return json.dumps({k: v for k, v in {**ARC, **changes}.items() if v is not ...})

    batch = bodies(
        spark,
        ("/1", 200, payload()),
        ("/2", 200, payload(headlines={"meta_title": "", "basic": "Basic"})),
        ("/3", 200, payload(headlines={"meta_title": "M"})),
        ("/4", 200, payload(canonical_url=...)),
        ("/5", 200, payload(publish_date=...)),
        ("/6", 200, payload(publish_date="2022-03-01T18:37:44Z")),
        ("/7", 200, payload(publish_date="2022")),
        ("/8", 200, payload(_id=...)),
        ("/9", 200, "no json"),
    )
    found = {r["path"]: r for r in extraction.metadata_from_arc_json(batch).collect()}
    assert (found["/1"]["title"], found["/1"]["new_path"], found["/1"]["new_external_id"]) == (
        "Meta", "/news/x.html", "TCK",
    )
    assert found["/2"]["title"] == "Basic"
    assert [found[f"/{i}"]["msg"] for i in range(1, 10)] == [
        None,
        None,
        "Article missing headline",
        "Article canonical URL missing",
        "Article publish date missing",
        None,
        "Cannot parse date of publication",
        "Error parsing external_id",
        "Cannot parse article response JSON",
    ]
    strict = extraction.metadata_from_arc_json(batch, strict_dates=True).filter("path = '/6'").first()
    assert strict["error_type"] == "malformed_api_response"


def test_tribune_metadata(spark):
    whole = {"headline": "H", "pub_date": "2022-03-04T11:22:33-06:00", "url": "https://x.org/a/b?c", "id": 12}
    batch = bodies(
        spark,
        ("/1", 200, json.dumps(whole)),
        ("/2", 200, json.dumps({**whole, "pub_date": None})),
        ("/3", 200, json.dumps({k: v for k, v in whole.items() if k != "url"})),
        ("/4", 200, "[]"),
    )
    found = extraction.metadata_from_tribune_json(batch)
    assert rows(found, "path", "title", "new_path", "new_external_id", "error_type")[:2] == [
        ("/1", "H", "/a/b", "12", None),
        ("/2", "H", "/a/b", "12", None),
    ]
    assert rows(found, "path", "error_type")[2:] == [("/3", "malformed_api_response"), ("/4", "fetch_error")]
    assert found.filter("path = '/2'").first()["published_at"] is None


def test_the_latest_response_counts(spark):
    data = [
        ("s", "page", "/a", None, "u1", 200, "old", "2021-01-01"),
        ("s", "page", "/a", None, "u2", 500, "new", "2021-01-02"),
        ("s", "article", "/a", "1", "u3", 200, "other", "2021-01-03"),
    ]
    columns = "site string, kind string, path string, external_id string, url string, status int, body string, t string"
    frame = spark.createDataFrame(data, columns)
    landed = frame.select("*", F.col("t").cast("timestamp").alias("fetched_at")).drop("t")
    found = extraction.latest_responses(landed, "page", "path")
    assert rows(found) == [("s", "/a", "u2", 500, "new")]
    assert [f.name for f in spark.createDataFrame([], schemas.RESPONSES).schema] == landed.columns


def test_a_site_of_ones_own(spark):
    """Rules given as functions, and validators as SQL."""

    def title_is_body(rows):
        return rows.select(
            "*",
            F.upper("body").alias("title"),
            F.lit("2021-01-01").cast("timestamp").alias("published_at"),
            F.col("path").alias("new_path"),
            F.col("external_id").alias("new_external_id"),
            F.when(F.col("body").isNull(), "fetch_error").alias("error_type"),
            F.lit(None).cast("string").alias("msg"),
        )

    by_path = extraction.METADATA_RULES["article_html"][0]
    site = config.SiteConfig(
        name="s",
        domain="d",
        hours_of_data=1,
        popularity_window=1,
        max_article_age=1,
        training=config.TrainingParams(),
        id_rule=(lambda df, _: df, lambda df: extraction.id_from_path(df, "^/x/([0-9]+)", 1)),
        metadata_rule=(by_path, title_is_body),
        bulk_rule=lambda listed, start, end: listed.select("path"),
        validators=(("body LIKE '%ad%'", "Advertisement"), ("length(body) > 3", "Too long")),
    )
    paths = spark.createDataFrame([("s", f"/x/{n}") for n in range(5)], "site string, path string")
    ids = extraction.extract_ids(site, paths, paths)
    assert rows(ids, "external_id") == [(str(n),) for n in range(5)]
    landed = [
        ("s", "page", f"/x/{n}", None, "u", status, body, None)
        for n, (status, body) in enumerate([(200, "ok"), (200, "an ad"), (200, "long"), (404, "an ad")])
    ] + [("s", "bulk", "/listed", None, "u", 200, "", None), ("t", "bulk", "/other", None, "u", 200, "", None)]
    responses = spark.createDataFrame(landed, schemas.RESPONSES)
    found = extraction.extract_metadata(site, ids, responses)
    assert rows(found, "external_id", "title", "error_type", "msg") == [
        ("0", "OK", None, None),
        ("1", "AN AD", "failed_site_validation", "Advertisement"),
        ("2", "LONG", "failed_site_validation", "Too long"),
        ("3", "AN AD", None, None),
        ("4", None, "fetch_error", None),
    ]
    assert rows(extraction.bulk_articles(site, responses, None, None)) == [("/listed",)]
