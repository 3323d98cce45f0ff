"""Distinct rows and one-row-per-key choices (AGG-6 to AGG-9).

The choices are aggregates over a struct, so each task sends at most one row per key into
the shuffle and a hot key stays cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.joins import fits_broadcast
from starmill.session import scratch_path


def distinct_of(df: DataFrame, columns: list) -> DataFrame:
    """Distinct combinations of the given columns."""
    return df.select(*columns).distinct()


def _one_per_key(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys]
    chosen = pick(F.struct(*ranked, *rest)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*[c if c in keys else f"_row.{c}" for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """The row with the smallest ``order`` values per key; the other columns break ties."""
    return _one_per_key(df, list(keys), list(order), F.min)


def last_per_key(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """The row with the greatest ``order`` values per key; the other columns break ties."""
    return _one_per_key(df, list(keys), list(order), F.max)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Hashes (``_hash``) of all keys that occur more than once, others may be among them; None if there are none.

    Eight bytes a row are moved, whatever the keys are.
    """
    counts = df.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    repeated, path = counts.filter(F.col("_n") > 1).select("_hash"), scratch_path(df.sparkSession, "repeated-keys")
    repeated.write.parquet(path)
    found = df.sparkSession.read.schema(repeated.schema).parquet(path)
    return None if found.isEmpty() else found


def first_of_repeated(df: DataFrame, keys: list[str], repeated: DataFrame | None, order: list[str] = ()) -> DataFrame:
    """``first_per_key`` where ``repeated_keys`` are known: rows of all other keys stay where they are."""
    if repeated is None:
        return df
    if not fits_broadcast(repeated):  # then most rows have to move in any case
        return first_per_key(df, keys, order)
    hashed, marks = df.withColumn("_hash", F.xxhash64(*keys)), F.broadcast(repeated)
    once = hashed.join(marks, "_hash", "left_anti").select(*df.columns)
    several = hashed.join(marks, "_hash", "left_semi").select(*df.columns)
    return once.unionByName(first_per_key(several, keys, order))


def latest_attributes(
    df: DataFrame, keys: list[str], order: str, changing: list[str], fixed: list[str]
) -> DataFrame:
    """Per key: ``changing`` and ``order`` from the latest row, ``fixed`` from the earliest.

    Rows are first counted down to the distinct attribute values with their first and last
    ``order``: a hash aggregate without sorting, after which few rows per key are left.
    """
    spans = df.groupBy(*keys, *changing, *fixed).agg(F.min(order).alias("_from"), F.max(order).alias("_to"))
    return (
        spans.groupBy(*keys)
        .agg(
            F.min(F.struct("_from", *fixed)).alias("_first"),
            F.max(F.struct("_to", *changing)).alias("_last"),
        )
        .select(
            *keys,
            *[f"_first.{c}" for c in fixed],
            *[f"_last.{c}" for c in changing],
            F.col("_last._to").alias(order),
        )
    )
