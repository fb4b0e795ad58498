"""The five update cases of a site whose ids are in the path."""

from datetime import datetime

import pytest
from conftest import rows

from pressroom import config, schemas
from pressroom.plans.metadata import update_metadata

SITE = config.CITY_PAPER
IDS = ["700101", "700205", "700333"]
PATHS = ["/article/700101/a", "/article/700205/b", "/article/700333/c"]
NOW = datetime(2021, 5, 1)

META = '<meta property="article:published_time" content="2022-03-04T05:06:07+00:00">'
GOOD = META + "<header><h1>Title</h1></header>"
EXCLUDED = GOOD + '<div id="primary"><p class="tag-exclude"></p></div>'
UNDATED = "<header><h1>Title</h1></header>"


def to_update(spark, ids=None):
    ids = ids or [None] * len(PATHS)
    data = [(SITE.name, p, i) for p, i in zip(PATHS, ids)]
    return spark.createDataFrame(data, "site string, landing_page_path string, external_id string")


def responses(spark, body, status=200, path_of=lambda p: p):
    data = [
        (SITE.name, "page", p, None, "https://washingtoncitypaper.com" + path_of(p), status, body, NOW)
        for p in PATHS
    ]
    return spark.createDataFrame(data, schemas.RESPONSES)


def stored(spark, with_ids=True):
    data = [
        (n, SITE.name, i, "old", p, datetime(2021, 4, 30), NOW, datetime(2021, 4, 30))
        for n, (i, p) in enumerate(zip(IDS, PATHS), 1)
    ]
    other = (9, "elsewhere", IDS[0], "same id", "/x", NOW, NOW, NOW)
    return spark.createDataFrame([*data, other] if with_ids else [], schemas.ARTICLES)


def run(spark, wanted, articles, landed):
    empty = spark.createDataFrame([], schemas.PATHS)
    return update_metadata(SITE, wanted, articles, empty, landed, datetime(2021, 5, 2))


def mine(articles):
    return articles.filter(f"site = '{SITE.name}'")


def test_new_valid(spark):
    update = run(spark, to_update(spark), stored(spark, False), responses(spark, GOOD))
    found = rows(mine(update.articles), "external_id", "title", "path", "id")
    assert found == [(i, "Title", p, n) for n, (i, p) in enumerate(zip(IDS, PATHS), 1)]
    assert rows(update.paths, "path", "external_id", "exclude_reason") == [
        (p, i, None) for i, p in zip(IDS, PATHS)
    ]
    assert update.errors.count() == 0


def test_existing_valid(spark):
    update = run(spark, to_update(spark, IDS), stored(spark), responses(spark, GOOD))
    found = rows(mine(update.articles), "external_id", "title", "updated_at")
    assert found == [(i, "Title", datetime(2021, 5, 2)) for i in IDS]
    assert update.articles.filter("site = 'elsewhere'").first()["title"] == "same id"
    assert update.paths.count() == 0


def test_failed_fetches_leave_no_trace(spark):
    update = run(spark, to_update(spark), stored(spark, False), responses(spark, GOOD, status=500))
    assert mine(update.articles).count() == 0 and update.paths.count() == 0
    assert rows(update.errors, "error_type") == [("fetch_error",)] * 3


def test_excluded_on_refresh_are_deleted_for_this_site_only(spark):
    update = run(spark, to_update(spark, IDS), stored(spark), responses(spark, EXCLUDED))
    assert rows(update.articles, "site") == [("elsewhere",)]
    assert rows(update.paths, "path", "exclude_reason") == [(p, "failed_site_validation") for p in PATHS]


def test_new_but_excluded_are_cached_as_excluded(spark):
    update = run(spark, to_update(spark), stored(spark, False), responses(spark, EXCLUDED))
    assert mine(update.articles).count() == 0
    assert rows(update.paths, "external_id", "exclude_reason") == [(None, "failed_site_validation")] * 3


def test_undated_are_tried_again(spark):
    update = run(spark, to_update(spark), stored(spark, False), responses(spark, UNDATED))
    assert mine(update.articles).count() == 0 and update.paths.count() == 0
    assert rows(update.errors, "error_type") == [("no_publish_date",)] * 3


def test_alias_of_a_known_article_and_canonical_path(spark):
    one = to_update(spark).filter("landing_page_path = '/article/700101/a'")
    alias = one.selectExpr("site", "'/v/s/washingtoncitypaper.com/article/700101/z' landing_page_path", "external_id")
    landed = responses(spark, GOOD, path_of=lambda p: "/food" + p)
    update = run(spark, one.unionByName(alias), stored(spark, False), landed)
    assert rows(mine(update.articles), "external_id", "path") == [("700101", "/food/article/700101/a")]
    assert rows(update.paths, "path", "external_id") == [
        ("/article/700101/a", "700101"),
        ("/food/article/700101/a", "700101"),
        ("/v/s/washingtoncitypaper.com/article/700101/z", "700101"),
    ]
    assert rows(update.errors, "error_type") == [("duplicate_path",)]


@pytest.mark.parametrize("name", ["no-such-site"])
def test_unknown_site(name):
    with pytest.raises(KeyError):
        config.get_site(name)
