"""Grouped counts, shares, probes and trends (AGG-1 to AGG-5, AGG-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_per(df: DataFrame, columns: list, name: str = "n") -> DataFrame:
    """Row count per group."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def count_by_joined(
    fact: DataFrame, dim: DataFrame, on: str, by: list[str], counted: str, name: str = "n"
) -> DataFrame:
    """Count fact rows per attribute of a left-joined dimension whose key is unique.

    Rows are counted per join key before the join, so a key held by many rows crosses the
    network once per task and the join sees one row per key.
    """
    per_key = fact.groupBy(on).agg(F.count(counted).alias("_n"))
    joined = per_key.join(dim.select(on, *by), on, "left")
    return joined.groupBy(*by).agg(F.sum("_n").alias(name))


def share_of_total(df: DataFrame, by: str, counted: str, exact: bool = False) -> DataFrame:
    """Count and percentage of all counted rows per group.

    The percentage is whole (integer division) unless ``exact``.
    """
    counts = df.groupBy(by).agg(F.count(counted).alias("n"))
    total = counts.select(F.sum("n").alias("total")).scalar()
    with_total = counts.withColumn("_total", total)
    percent = F.expr("100.0D * n / _total") if exact else F.expr("100 * n div _total")
    return with_total.select(by, "n", percent.alias("percent"))


def non_empty_flag(df: DataFrame) -> DataFrame:
    """One row: 1 when the table has rows, else 0."""
    return df.agg(F.when(F.count(F.lit(1)) > 0, 1).otherwise(0).alias("row_flag"))


def max_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: the greatest number of rows that share a key (1 = the key is unique)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n").alias("max_count"))


def snapshot_probe(df: DataFrame, as_of: str) -> DataFrame:
    """One row: number of dated records and the latest date."""
    return df.agg(F.count(as_of).alias("row_count"), F.max(as_of).alias("max_as_of"))


def trend(df: DataFrame, attributes: list, ts: Column, unit: str = "MONTH", weight: str | None = None) -> DataFrame:
    """Counts per attribute and period; ``weight`` sums a column of counts instead."""
    period = F.date_trunc(unit, ts).cast("date").alias("period")
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*attributes, period).agg(n.alias("n"))
