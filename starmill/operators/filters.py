"""Row filters (FIL-1 to FIL-8). All are plain predicates, so they reach the file scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def keep_type(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows of one kind, such as one page of an app log."""
    return df.filter(F.col(column) == value)


def require_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.filter(_all_of([F.col(c).isNotNull() for c in columns]))


def require_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of the text columns is NULL or empty."""
    return df.filter(_all_of([F.col(c).isNotNull() & (F.col(c) != "") for c in columns]))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any NULL."""
    return df.dropna(how="any")


def in_period(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= column < end``; bounds are timestamp text."""
    ts = F.col(column)
    return df.filter((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))


def lookup(df: DataFrame, **key: object) -> DataFrame:
    """Point lookup on a full key or on its partition part."""
    return df.filter(_all_of([F.col(c) == F.lit(v) for c, v in key.items()]))


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` equals the greatest value in the table.

    The maximum is a scalar subquery: the first pass reads that one column, the second pass
    filters with its result.
    """
    return df.filter(F.col(column) == df.select(F.max(column)).scalar())
