"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.duck import with_views
from checks.inputs import plain
from pressroom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: str = ""):
    """Register a function under its own name; ``views`` lists the SQL views it reads."""

    def register(function):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return plain(function(configure(spark), sf))

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = with_views(sql, *views.split())
        return run

    return register
