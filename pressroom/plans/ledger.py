"""What a run has finished already: after a crash the next attempt goes on from there."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from pressroom.sources import files


class Ledger:
    """Finished stages of one run of a site, each with what it has produced (a commit, a model id).

    A stage is recorded by giving a complete file its name, after its tables are written. What a stage writes is replaced by a repeated attempt, so a
    crash between the two costs time only. A run that has ended forgets its ledger: called again, it does everything again.
    """

    def __init__(self, spark: SparkSession, base: str, site: str, run: str):
        self.spark, self.path = spark, f"{base}/ledger/site={site}/run={run}"

    def finished(self) -> list[str]:
        return sorted(n for n in files.children(self.spark, self.path) if not n.startswith("_"))

    def facts(self, stage: str) -> dict | None:
        """What a stage has recorded; None if it hasn't finished."""
        return json.loads(files.read_text(self.spark, f"{self.path}/{stage}")) if stage in self.finished() else None

    def record(self, stage: str, facts: dict) -> None:
        pending = f"{self.path}/_{stage}-{uuid.uuid4().hex}"
        files.write_text(self.spark, pending, json.dumps(facts))
        files.move(self.spark, pending, f"{self.path}/{stage}")

    def once(self, stage: str, work: Callable[[], dict | None]) -> dict:
        """The facts of a stage, which is worked off unless it has been."""
        known = self.facts(stage)
        if known is None:
            known = work() or {}
            self.record(stage, known)
        return known

    def close(self) -> None:
        files.remove(self.spark, self.path)
