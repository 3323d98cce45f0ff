"""Runs by date and step, recorded as they go (PIPE-4).

A step that is recorded as done for a date is not run again, so a run that failed goes on at the
step it failed at, and dates that were missed are made up for in order. A step may have
done its work without being recorded; steps are therefore such that running them again changes
nothing, as all loads here are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from starmill.sinks import paths

SCHEMA = "run_date date, step string, state string, at timestamp"
DONE, FAILED = "done", "failed"


class Ledger:
    """A folder of one row per step and attempt."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not paths.exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def done(self, run_date: date) -> set[str]:
        """The steps of a date that need not run again."""
        rows = self.rows()
        found = rows.filter((rows.run_date == run_date) & (rows.state == DONE)).select("step").distinct()
        return {r.step for r in found.collect()}

    def record(self, run_date: date, step: str, state: str) -> None:
        row = self.spark.createDataFrame([(run_date, step, state, datetime.now(UTC))], SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)


def run_steps(ledger: Ledger, run_date: date, steps: Mapping[str, Callable[[date], object]]) -> list[str]:
    """Run the steps of a date that are not done, in order; returns their names. The first that fails ends it."""
    known, ran = ledger.done(run_date), []
    for name, step in steps.items():
        if name in known:
            continue
        try:
            step(run_date)
        except Exception:
            ledger.record(run_date, name, FAILED)
            raise
        ledger.record(run_date, name, DONE)
        ran.append(name)
    return ran


def backfill(ledger: Ledger, dates: Iterable[date], steps: Mapping[str, Callable[[date], object]]) -> dict[date, list[str]]:
    """Run what is missing of every date, oldest first; stops at the first step that fails.

    A later date builds on the tables of the earlier ones, so none is run past a failed one.
    """
    return {day: run_steps(ledger, day, steps) for day in sorted(set(dates))}
