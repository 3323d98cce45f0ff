"""Data-quality checks, reject splits and load reports (DQ-1 to DQ-7, AGG-10)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.aggregates import max_key_count, non_empty_flag
from starmill.operators.joins import orphan_keys


class QualityError(AssertionError):
    """Raised when a check's value differs from the expected one."""


@dataclass(frozen=True)
class Check:
    """A query that gives one number, the table it is about and the number expected.

    ``query`` is a one-row, one-column DataFrame, or SQL text in which ``{}`` stands for
    the table name.
    """

    name: str
    query: DataFrame | str
    table: str
    expected: int


def not_empty(name: str, df: DataFrame) -> Check:
    return Check("not_empty", non_empty_flag(df), name, 1)


def unique_key(name: str, df: DataFrame, keys: list[str]) -> Check:
    most = max_key_count(df, keys)
    # an empty table has no key twice; that it is empty is another check's finding
    return Check("unique_" + "_".join(keys), most.select(F.coalesce(F.col(most.columns[0]), F.lit(1))), name, 1)


def no_nulls(name: str, df: DataFrame, columns: list[str]) -> Check:
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return Check("not_null", df.agg(F.count_if(bad).alias("bad")), name, 0)


def no_orphans(name: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> Check:
    orphans = orphan_keys(child, key, parent, parent_key)
    return Check(f"foreign_key_{key}", orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0))), name, 0)


def check_results(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """One row per check: name, table, expected, actual, passed. One job for all of them."""
    rows = []
    for check in checks:
        query = check.query
        if isinstance(query, str):
            query = spark.sql(query.format(check.table))
        value = F.col(f"`{query.columns[0]}`").cast("bigint")
        rows.append(
            query.select(
                F.lit(check.name).alias("check_name"),
                F.lit(check.table).alias("table_name"),
                F.lit(check.expected).cast("bigint").alias("expected"),
                value.alias("actual"),
                value.eqNullSafe(F.lit(check.expected).cast("bigint")).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def run_checks(spark: SparkSession, checks: list[Check]) -> list:
    """Run the checks and raise ``QualityError`` naming every one that fails."""
    results = check_results(spark, checks).collect()  # one row per check
    failed = [r for r in results if not r["passed"]]
    if failed:
        text = "; ".join(
            f"{r['table_name']}.{r['check_name']}: expected {r['expected']}, got {r['actual']}" for r in failed
        )
        raise QualityError(text)
    return results


def null_counts(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """NULLs per column in one pass: table_name, column_name, n_nulls."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in columns])
    return counts.select(F.lit(table).alias("table_name"), F.inline(pairs))


def with_reject_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first rule whose condition holds, or NULL for a good row."""
    reason = F.lit(None).cast("string")
    for name, condition in reversed(list(rules.items())):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason)."""
    marked = with_reject_reason(df, rules)
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())


def load_report(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """rows_in, rows_out and rejected per table, given each input and its keep-condition."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(keep).alias("rows_out")).select(
            F.lit(name).alias("table_name"),
            "rows_in",
            "rows_out",
            (F.col("rows_in") - F.col("rows_out")).alias("rejected"),
        )
        for name, (df, keep) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)
