"""Equi-joins of a large table with a lookup table (JN-1 to JN-11).

``lookup_join`` measures the lookup side. Within a fixed size it is broadcast and the large side
is not moved at all. Beyond it both sides are shuffled, and keys that hold a large share of the
rows are salted, so no task receives a hot key whole. Both ways give the same rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
MIN_SALTS = 32
HOT_SHARE = 1 / 128
MAX_HOT = 4096


def _row_bytes(df: DataFrame) -> Column:
    sizes: list[Column] = [F.lit(8 * len(df.columns))]
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            as_text = F.to_json(F.struct(F.col(field.name)))
            sizes.append(F.coalesce(F.octet_length(as_text), F.lit(0)))
    return reduce(lambda a, b: a + b, sizes)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure the table against the broadcast bound: rows and bytes in one pass over it."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df).cast("bigint"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def _any_null(on: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_share(partitions: int) -> float:
    """The share beyond which a key is hot: four mean shuffle partitions, 1/128 at most."""
    return min(HOT_SHARE, max(4 / partitions, 1 / MAX_HOT))


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of the rows, at most ``1/share`` of them, each with its
    share as ``_part``.

    Counts are merged inside each task before the shuffle; only the hot keys, whose number
    is bounded by the share, reach the driver.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.select(F.sum("_n")).scalar()
    hot = counts.filter(F.col("_n") > total * F.lit(share))
    return hot.select(*on, (F.col("_n") / F.lit(total)).alias("_part")).collect()


def few_keys(df: DataFrame, on: list[str]) -> bool:
    """Whether the distinct keys fit the broadcast bound; they are gathered only if an estimate lets them."""
    estimate = df.select(F.approx_count_distinct(F.xxhash64(*on))).first()[0]
    return estimate <= 2 * BROADCAST_ROWS and fits_broadcast(df.select(*on).distinct())


def may_have_hot_keys(df: DataFrame, on: list[str], share: float | None = None) -> bool:
    """Whether one key may hold more than a hot share of the rows; False is certain.

    Each task counts hashes of its keys in a sketch of fixed size, so no keys are shuffled. The
    sketch names every key with more than a quarter of a hot share and never counts one too low.
    """
    share = share or hot_share(_partitions(df))
    tracked = min(1 << 18, max(1024, 16 * math.ceil(1 / share)))
    counted = df.select(F.xxhash64(*on).alias("_key")).agg(
        F.count(F.lit(1)), F.expr(f"get(approx_top_k(_key, 1, {tracked}), 0).count")
    )
    total, most = counted.first()
    return (most or 0) > max(1, total * share)


def salted_join(
    fact: DataFrame, dim: DataFrame, on: list[str], how: str = "inner",
    hot_from: DataFrame | None = None, share: float | None = None,
) -> DataFrame:
    """Shuffled join in which hot keys of ``fact`` are spread over groups by salts.

    Without hot keys it is a plain join. ``hot_from`` is the table to look for hot keys in; give
    it when ``fact`` is itself the result of joins and a table it came from has the same keys.
    What is hot and how many salts a key has follow from the rows of a mean shuffle partition, so
    a salted group is about one partition. That decides where rows go, never which rows come out.

    A row's salt is a hash of its content, so a task run again after a lost executor puts it
    in the same place; rows equal in all columns share a salt, and AQE's skew join splits those.
    Only lookup rows of hot keys are repeated. Rows with a NULL key never match: a left join
    spreads them by salt, an inner join drops them before the shuffle.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join does inner and left joins")
    on = list(on)
    partitions = _partitions(fact)
    source, share = fact if hot_from is None else hot_from, share or hot_share(partitions)
    found = hot_keys(source, on, share) if may_have_hot_keys(source, on, share) else []
    salts = [(*tuple(r)[:-1], max(MIN_SALTS, math.ceil(r["_part"] * partitions))) for r in found]
    hot = [row for row in salts if None not in row]
    if not hot and (how == "inner" or len(found) == 0):
        return fact.join(dim, on, how)
    schema = T.StructType([T.StructField(c, fact.schema[c].dataType) for c in on]).add("_salts", T.IntegerType())
    marks = F.broadcast(fact.sparkSession.createDataFrame(hot, schema))
    unmatched = max((row[-1] for row in salts if None in row), default=MIN_SALTS)
    spread = F.when(_any_null(on), F.lit(unmatched)).otherwise(F.coalesce("_salts", F.lit(1)))
    content = F.xxhash64(*[F.col(c) for c in fact.columns])
    source = fact.filter(~_any_null(on)) if how == "inner" else fact
    left = source.join(marks, on, "left").withColumn("_salt", F.pmod(content, spread).cast("int")).drop("_salts")
    right = (
        dim.join(marks, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: list[str], how: str = "inner",
    measured: DataFrame | None = None, hot_from: DataFrame | None = None,
) -> DataFrame:
    """Join a large table with a lookup table by size: broadcast or salted shuffle.

    ``measured`` is a table at least as large as ``dim`` that is cheaper to measure, such as
    the one ``dim`` was made from; ``hot_from`` is explained at ``salted_join``.
    """
    if fits_broadcast(dim if measured is None else measured):
        return fact.join(F.broadcast(dim), list(on), how)
    return salted_join(fact, dim, on, how, hot_from)


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys in ``child`` without a row in ``parent``, with the number of child rows.

    Both sides are brought down to one row per key before the join, so a hot key stays small.
    """
    keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("orphan_key")).distinct()
    return keys.join(parents, "orphan_key", "left_anti")
