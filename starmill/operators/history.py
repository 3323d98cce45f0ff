"""Validity intervals from dated snapshots: gaps and islands (SRC-11).

A snapshot is a complete list of what held on its date. ``validity`` turns snapshots into one row per
key and unbroken run of equal values: valid from the first snapshot of the run until the first one that
no longer shows it. A key that is missing from a snapshot ends there; it starts anew when it comes back.

The rows of a key are walked in stretches of ``STRETCH`` snapshots, each a group of its own. Only a
stretch's first and last row go to the next step, which ties the stretches of a key together. So a key with very
many dates stays in several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.operators.joins import lookup_join
from starmill.operators.surrogate import dense_ids

STRETCH = 1024


def snapshot_dates(df: DataFrame, date: str) -> DataFrame:
    """Every snapshot's date with its number in time and the date of the one after it."""
    dates = df.filter(F.col(date).isNotNull()).select(F.col(date).alias("_date")).distinct()
    numbered = dense_ids(dates, ["_date"], "_at")
    following = numbered.select((F.col("_at") - 1).alias("_at"), F.col("_date").alias("_next"))
    return numbered.join(following, "_at", "left").select(F.col("_date").alias(date), "_at", "_next")


def validity(
    df: DataFrame, keys: Sequence[str], date: str, values: Sequence[str], start: str = "valid_from", end: str = "valid_to"
) -> DataFrame:
    """keys, values, start, end (NULL while the newest snapshot shows them); one row per run of equal values.

    Of several rows of a key in one snapshot the one with the greatest values counts. Rows without a
    date are no snapshot. NULL is a value, and a key, like any other.
    """
    keys, values = list(keys), list(values)
    state = F.struct(*values)
    seen = df.filter(F.col(date).isNotNull()).groupBy(*keys, date).agg(F.max(state).alias("_state"))
    placed = lookup_join(seen, snapshot_dates(df, date), [date])
    placed = placed.withColumn("_stretch", F.floor(F.col("_at") / STRETCH))
    at = F.struct("_at", "_state")

    def begins(before: Column) -> Column:
        """Whether a row starts a run, given the row of its key before it."""
        follows = (before.getField("_at") + 1 == F.col("_at")) & before.getField("_state").eqNullSafe(F.col("_state"))
        return ~F.coalesce(follows, F.lit(False))

    # inside a stretch; its first row is decided below
    inside = Window.partitionBy(*keys, "_stretch").orderBy("_at")
    walked = placed.withColumn("_before", F.lag(at).over(inside))
    walked = walked.withColumn("_inner", (F.col("_before").isNotNull() & begins(F.col("_before"))).cast("long"))
    walked = walked.withColumn("_run", F.sum("_inner").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # between stretches
    ends = walked.groupBy(*keys, "_stretch").agg(
        F.min(at).alias("_first"), F.max(at).alias("_last"), F.sum("_inner").alias("_inner_runs")
    )
    along = Window.partitionBy(*keys).orderBy("_stretch")
    tied = ends.withColumn("_before", F.lag("_last").over(along)).select("*", "_first.*")
    tied = tied.withColumn("_opens", begins(F.col("_before")).cast("long"))
    runs = F.sum(F.col("_inner_runs") + F.col("_opens")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    offsets = tied.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_stretch").alias("_part"),
        (F.coalesce(runs, F.lit(0)) + F.col("_opens")).alias("_offset"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys] + [F.col("_stretch") == F.col("_part")]
    numbered = walked.join(offsets, same).select(
        *keys, date, "_at", "_next", "_state", (F.col("_run") + F.col("_offset")).alias("_run")
    )
    last = F.max(F.struct("_at", "_next")).getField("_next")
    found = numbered.groupBy(*keys, "_run").agg(F.min(date).alias(start), last.alias(end), F.first("_state").alias("_state"))
    return found.select(*keys, *[F.col("_state").getField(v).alias(v) for v in values], start, end)


def as_of(history: DataFrame, when: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """The rows that held at a time."""
    return history.filter((F.col(start) <= when) & (F.col(end).isNull() | (F.col(end) > when)))


def changes(
    history: DataFrame, keys: Sequence[str], values: Sequence[str], old: Column, new: Column,
    start: str = "valid_from", end: str = "valid_to",
) -> DataFrame:
    """What differs between two times: keys, change (insert, change, close), old_ and new_ values.

    Both states come from one scan and meet per key; unchanged keys are left out.
    """
    def held(when: Column) -> Column:
        return (F.col(start) <= when) & (F.col(end).isNull() | (F.col(end) > when))

    state = F.struct(*values)
    both = history.filter(held(old) | held(new)).groupBy(*keys).agg(
        F.max(F.when(held(old), state)).alias("_old"), F.max(F.when(held(new), state)).alias("_new")
    )
    kind = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "close").otherwise("change")
    differing = both.filter(~F.col("_old").eqNullSafe(F.col("_new")))
    return differing.select(
        *keys, kind.alias("change"),
        *[F.col(side).getField(v).alias(f"{side[1:]}_{v}") for v in values for side in ("_old", "_new")],
    )
