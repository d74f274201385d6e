"""Row-level checks counted on the write itself, and the rows that fail them.

A write of a model observes one counter for each declared row-level check of it.  Where a counter isn't zero, the rows just
written are read once more and the failing ones stored in ``<warehouse>/quarantine/checks/<model>/scope=...``.  Counts are
kept per scope, which is what one write replaces: a date, a staged run, a version, or a whole table ("all"); they
lie in ``<warehouse>/quality_measures/<model>`` as one numbered JSON file, committed by a rename.

The counters only tell whether there is a failing row (a stage that runs twice counts twice); numbers come from the stored
rows.  The scopes of a write lose their measure before it begins, so a job that dies in between leaves them unmeasured
and ``summary`` is None until they are written again: whoever asks then has to scan.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolake.operators import incremental as INC
from aerolake.operators import quality as DQ


class Measures:
    """Measures of the models of one warehouse; one job writes at a time."""

    def __init__(self, spark: SparkSession, warehouse: str) -> None:
        self.spark, self.root = spark, warehouse.rstrip("/")

    def quarantine(self, model: str) -> str:
        return f"{self.root}/quarantine/checks/{model}"

    def _numbers(self, model: str) -> list[int]:
        names = INC.children(self.spark, f"{self.root}/quality_measures/{model}")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, model: str) -> dict[str, dict[str, int]]:
        """Failing rows of each check (by its label) in each measured scope."""
        numbers = self._numbers(model)
        if not numbers:
            return {}
        fs, path = INC.filesystem(self.spark, f"{self.root}/quality_measures/{model}/{numbers[-1]:09d}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _save(self, model: str, measured: dict) -> None:
        folder, before = f"{self.root}/quality_measures/{model}", self._numbers(model)
        number = before[-1] + 1 if before else 1
        fs, target = INC.filesystem(self.spark, f"{folder}/{number:09d}.json")
        _, draft = INC.filesystem(self.spark, f"{folder}/.{number:09d}.draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(measured).encode()))
        finally:
            stream.close()
        if not fs.rename(draft, target):
            raise OSError(f"measure {target} can't be written")
        INC.remove(self.spark, [f"{folder}/{n:09d}.json" for n in before])

    def forget(self, model: str, scopes: Sequence[str]) -> None:
        """Scopes that are about to be replaced, or are gone: no measure, no stored rows."""
        measured = self.read(model)
        if measured.keys() & set(scopes):
            self._save(model, {s: counts for s, counts in measured.items() if s not in scopes})
        INC.remove(self.spark, [f"{self.quarantine(model)}/scope={s}" for s in scopes])

    def write(self, model: str, df: DataFrame, write: Callable[[DataFrame], object], stored: Callable[[], DataFrame],
              scopes: Sequence[str] = ("all",), scope: Column | None = None) -> int:
        """``write`` the frame with its checks observed; the number of its rows.

        ``stored`` reads what was written; ``scope`` gives a row's scope where there are several.
        """
        checks = DQ.row_level_checks(model)
        self.forget(model, scopes)
        seen = Observation(f"checks of {model}")
        write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(DQ.violates(c)).alias(f"c{i}") for i, c in enumerate(checks)]))
        try:
            found = seen.get
        except Py4JJavaError:  # Spark knew the frame to be empty and dropped it from the plan
            found = {}
        counts = {s: {DQ.label(c): 0 for c in checks} for s in scopes}
        failing = [c for i, c in enumerate(checks) if found.get(f"c{i}", 0)]
        if failing:
            path = self.quarantine(model)
            rows = DQ.quarantined(stored(), failing).withColumn("scope", F.lit(scopes[0]) if scope is None else scope)
            rows.select("test", "column_name", "row", "scope").write.mode("append").partitionBy("scope").parquet(path)
            kept = self.spark.read.schema("test string, column_name string, row string, scope string").parquet(path).filter(F.col("scope").isin(*scopes))
            groups = kept.groupBy("scope", "test", "column_name").count()
            for r in groups.agg(F.collect_list(F.struct(*groups.columns)).alias("found")).first().found:  # checks x scopes of this write
                counts[r.scope][f"{r.test} {r.column_name}"] = r["count"]
        self._save(model, {**self.read(model), **counts})
        return found.get("rows", 0)

    def summary(self, checks: Sequence[DQ.Check], model: str, scopes: Sequence[str]) -> list[tuple] | None:
        """(test, model, column_name, failing_rows) of row-level checks over the scopes that the table has; None where one isn't measured."""
        measured = self.read(model)
        if any(DQ.label(c) not in measured.get(s, {}) for s in scopes for c in checks):
            return None
        return [(c.kind, model, c.column, sum(measured[s][DQ.label(c)] for s in scopes)) for c in checks]
