from datetime import datetime

import pytest
from conftest import rows

from pressroom import schemas
from pressroom.operators import registry

OLD, NOW = datetime(2021, 1, 1), datetime(2021, 2, 1)


def models(spark):
    data = [
        (1, "article", "stale", "s"),
        (2, "article", "stale", "s"),
        (3, "article", "stale", "s"),
        (4, "article", "current", "s"),
        (5, "article", "pending", "s"),
        (6, "popularity", "current", "s"),
        (7, "article", "current", "t"),
    ]
    return spark.createDataFrame([(*m, OLD, OLD) for m in data], schemas.MODELS)


def test_promotion(spark):
    found = registry.promote_model(models(spark), 5, "article", "s", NOW)
    assert rows(found, "id", "status", "updated_at") == [
        (3, "stale", OLD),
        (4, "stale", NOW),
        (5, "current", NOW),
        (6, "current", OLD),
        (7, "current", OLD),
    ]


def test_registering(spark):
    table = models(spark)
    number = registry.next_model_id(table)
    more = registry.register_model(table, number, "popularity", "t", NOW)
    assert number == 8 and rows(more.filter("id = 8"), "type", "status", "site") == [("popularity", "pending", "t")]
    assert registry.next_model_id(spark.createDataFrame([], schemas.MODELS)) == 1
    with pytest.raises(ValueError):
        registry.register_model(table, 9, "nonsense", "t", NOW)


def test_recs_live_as_long_as_their_model(spark):
    recs = spark.createDataFrame([("default", m, None, m) for m in (1, 4, 6, 99)], schemas.RECOMMENDATIONS)
    table = models(spark)
    assert rows(registry.live_recs(recs, table), "model_id") == [(1,), (4,), (6,)]
    assert rows(registry.served_recs(recs, table, "article", "s"), "model_id") == [(4,)]
