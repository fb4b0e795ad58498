"""Counts and timings of a run, taken while the data passes."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressroom import schemas


def observed(observation: Observation) -> dict:
    """What was observed; nothing when the plan turned out to be empty and the observed part of it never ran."""
    try:
        return dict(observation.get)
    except Py4JJavaError as error:
        if "assertion failed" in str(error):
            return {}
        raise


class RunMetrics:
    """Collects ``(name, value, unit, tags)`` rows; counting costs no extra pass."""

    def __init__(self, run_id: str, **tags: str):
        self.run_id = run_id
        self.tags = {k: str(v) for k, v in tags.items()}
        self._observed: list[tuple[Observation, list[str]]] = []
        self._rows: list[tuple] = []

    def counted(self, df: DataFrame, name: str, **when) -> DataFrame:
        """Count the rows of ``df`` under ``name`` when it is written, and the rows where a
        condition holds under each further name."""
        observation = Observation(f"{self.run_id}:{name}:{len(self._observed)}")
        counts = [F.count(F.lit(1)).alias(name)]
        counts += [F.count_if(condition).alias(other) for other, condition in when.items()]
        self._observed.append((observation, [name, *when]))
        return df.observe(observation, *counts)

    def add(self, name: str, value: float, unit: str = "Count", **tags) -> None:
        self._rows.append((self.run_id, name, float(value), unit, {**self.tags, **tags}))

    def added(self) -> list[tuple]:
        """Rows known without waiting for a count whose job may never have run."""
        return list(self._rows)

    def rows(self) -> list[tuple]:
        for observation, names in self._observed:
            counts = observed(observation)
            for name in names:
                self.add(name, counts.get(name, 0))
        self._observed = []
        return list(self._rows)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), schemas.RUN_METRICS)


def run_counts(events: DataFrame) -> DataFrame:
    """Per site: events, pings, and ping rows folded into them."""
    return events.groupBy("site").agg(
        F.count(F.lit(1)).alias("written_events"),
        F.count("ping_count").alias("ping_rows"),
        F.coalesce(F.sum("ping_count"), F.lit(0)).alias("pings"),
    )
