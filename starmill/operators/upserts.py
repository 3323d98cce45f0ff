"""Insert-if-absent and update-to-latest merges (UPS-1, UPS-2).

A batch is normally far smaller than the table. When its keys fit the broadcast bound, the
table is filtered where it lies and only the rows the batch touches are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.dedupe import first_per_key, latest_attributes
from starmill.operators.joins import few_keys, fits_broadcast
from starmill.session import scratch_path
from starmill.sinks import paths


def _by_key(rows: DataFrame, keys_of: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join on the keys; NULL is a key like any other, or each load would add it again."""
    other = keys_of.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return rows.join(other, same, how)


def new_rows(existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Rows of the batch to append: one per key, and only keys the table does not hold."""
    keys = list(keys)
    candidates = first_per_key(batch, keys, order)
    known = existing.select(*keys)
    batch_keys = batch.select(*keys).distinct()
    if fits_broadcast(batch_keys):
        known = _by_key(known, F.broadcast(batch_keys), keys, "left_semi")
    return _by_key(candidates, known.distinct(), keys, "left_anti")


def absent_rows(known: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of a stored batch whose key is not among the known ones.

    With few known or few new keys the batch stays where it is; otherwise keys alone are moved to find the
    new ones, and rows only if those are many.
    """
    keys = list(keys)
    known = known.select(*keys)
    if fits_broadcast(known):
        return _by_key(batch, F.broadcast(known), keys, "left_anti")
    if few_keys(batch, keys):
        met = _by_key(known, F.broadcast(batch.select(*keys).distinct()), keys, "left_semi").distinct()
        return _by_key(batch, F.broadcast(met), keys, "left_anti")
    spark, path = batch.sparkSession, scratch_path(batch.sparkSession, "absent-keys")
    _by_key(batch.select(*keys), known, keys, "left_anti").write.parquet(path)
    absent = spark.read.schema(batch.select(*keys).schema).parquet(path)
    if fits_broadcast(absent):
        return _by_key(batch, F.broadcast(absent), keys, "left_semi")
    paths.remove(spark, path)
    return _by_key(batch, known, keys, "left_anti")


def insert_if_absent(
    existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str] = ()
) -> DataFrame:
    """The table after inserting the batch; a key already present keeps its row."""
    return existing.unionByName(new_rows(existing, batch, keys, order))


def fold_latest(rows: DataFrame, keys: list[str], order: str, changing: list[str], fixed: list[str]) -> DataFrame:
    """Stored (``_batch`` 0) and incoming rows (1) of each key to one; a stored row names the fixed
    columns and wins a tie on order."""
    # at most two rows per key
    return (
        rows.groupBy(*keys)
        .agg(
            F.min(F.struct("_batch", *fixed)).alias("_first"),
            F.max(F.struct(F.col(order), -F.col("_batch"), *changing)).alias("_last"),
        )
        .select(
            *keys,
            *[f"_first.{c}" for c in fixed],
            *[f"_last.{c}" for c in changing],
            f"_last.{order}",
        )
    )


def merge_latest(
    existing: DataFrame, batch: DataFrame, keys: list[str], order: str, changing: list[str]
) -> DataFrame:
    """The table after the batch: ``changing`` follows the row with the greatest ``order``.

    All other columns keep the value of the row that came first.
    """
    keys = list(keys)
    columns = existing.columns
    fixed = [c for c in columns if c not in keys and c not in changing and c != order]
    incoming = latest_attributes(batch, keys, order, list(changing), fixed).withColumn("_batch", F.lit(1))
    batch_keys = batch.select(*keys).distinct()
    if fits_broadcast(batch_keys):
        small = F.broadcast(batch_keys)
        touched = _by_key(existing, small, keys, "left_semi").withColumn("_batch", F.lit(0))
        untouched = _by_key(existing, small, keys, "left_anti")
        merged = fold_latest(touched.unionByName(incoming), keys, order, changing, fixed)
        return untouched.unionByName(merged)
    rows = existing.withColumn("_batch", F.lit(0)).unionByName(incoming)
    return fold_latest(rows, keys, order, changing, fixed).select(*columns)
