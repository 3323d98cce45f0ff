"""Unions (SET-1, SET-2, PRJ-4, PRJ-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Distinct rows of all frames; each task removes its own duplicates before the shuffle."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame)
    return result.distinct()


def append_aligned(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name; a column a frame lacks is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types; absent ones are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def sorted_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order, for sinks that match by position."""
    return df.select(*[f"`{c}`" for c in sorted(df.columns)])
