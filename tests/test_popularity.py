from datetime import date
from decimal import Decimal

from conftest import rows

from pressroom import schemas
from pressroom.operators import popularity

DAY = date(2021, 3, 10)


def dwell(spark, *items):
    data = [(n, u, a, str(a), p, "s", d) for n, u, a, p, d in items]
    return spark.createDataFrame(data, schemas.DWELL_TIMES)


def test_two_articles_of_today_both_score_one(spark):
    frame = dwell(spark, (1, "u", 123, DAY, DAY), (1, "u", 456, DAY, DAY))
    recs = popularity.popularity_recs(frame, DAY, 7, "s")
    assert rows(recs) == [("default", 123, Decimal("1.000000")), ("default", 456, Decimal("1.000000"))]


def test_window_site_decay_and_ties(spark):
    frame = dwell(
        spark,
        (100, "u", 1, date(2021, 2, 28), DAY),
        (100, "v", 2, DAY, date(2021, 3, 4)),
        (900, "u", 3, DAY, date(2021, 3, 3)),
        (60, "u", 2, DAY, DAY),
    )
    top = popularity.popularity(frame, DAY, 7, "s")
    assert [(r["article_id"], r["score"], r["n_users"]) for r in top.collect()] == [(2, 160, 2), (1, 100, 1)]
    recs = popularity.popularity_recs(frame, DAY, 7, "s")
    assert rows(recs, "recommended_article_id", "score") == [(1, Decimal("0.312500")), (2, Decimal("1.000000"))]
    assert popularity.popularity(frame, DAY, 7, "other").count() == 0
    assert rows(popularity.popularity_recs(frame, DAY, 7, "s", max_recs=1), "recommended_article_id") == [(2,)]


def test_all_zero_scores_do_not_fail(spark):
    frame = dwell(spark, (0, "u", 1, DAY, DAY))
    assert rows(popularity.popularity_recs(frame, DAY, 7), "score") == [(None,)]


def test_equal_scores_are_cut_by_id(spark):
    frame = dwell(spark, *[(10, "u", a, DAY, DAY) for a in range(60)])
    kept = popularity.popularity(frame, DAY, 7)
    assert [r["article_id"] for r in kept.collect()] == list(range(50))
