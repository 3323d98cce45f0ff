"""Row counts taken while a load writes (AGG-10).

``load_report`` counts on scans of its own. Here an observation rides on the write: rows in, rows out
and rows per reject reason are known when the write is done, and the input is read once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmill.operators.quality import with_reject_reason
from starmill.sinks.tables import write_table

REPORT = "table_name string, rows_in long, rows_out long, rejected long"


def write_counted(
    df: DataFrame, path: str, rules: Mapping[str, Column] | None = None, rejects: str | None = None, **options
) -> dict[str, int]:
    """Write the rows that no rule rejects; returns rows_in, rows_out, rejected and the count of each rule.

    With ``rejects``, a folder, rejected rows are kept there with their reason; they are found by a second
    pass, over an input that is best staged. ``options`` are those of ``write_table``.
    """
    rules = dict(rules or {})
    marked = with_reject_reason(df, rules)
    reason, observation = F.col("reject_reason"), Observation()
    counts = [F.count(F.lit(1)).alias("rows_in"), F.count_if(reason.isNull()).alias("rows_out")]
    counts += [F.count_if(reason == name).alias(f"rule_{i}") for i, name in enumerate(rules)]
    observed = marked.observe(observation, *counts)
    write_table(observed.filter(reason.isNull()).drop("reject_reason"), path, **options)
    found = observation.get
    if rejects is not None:
        write_table(marked.filter(reason.isNotNull()), rejects)
    return {
        "rows_in": found["rows_in"], "rows_out": found["rows_out"], "rejected": found["rows_in"] - found["rows_out"],
        **{name: found[f"rule_{i}"] for i, name in enumerate(rules)},
    }


def report(spark: SparkSession, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Counts by table as rows: table_name, rows_in, rows_out, rejected."""
    rows = [(name, c["rows_in"], c["rows_out"], c["rejected"]) for name, c in counts.items()]
    return spark.createDataFrame(rows, REPORT)
