"""Dated snapshots: everything, or the latest only (SRC-11, SRC-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starmill.operators.filters import at_latest


def snapshots(df: DataFrame, as_of: str, latest_only: bool = False) -> DataFrame:
    """All snapshots for a first load, the newest one for a periodic update."""
    return at_latest(df, as_of) if latest_only else df
