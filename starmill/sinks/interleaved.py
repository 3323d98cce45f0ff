"""Several sort keys at once: rows along a space-filling curve (SRT-4, FIL-8).

Sorted by one column, a table can skip row groups for filters on that column alone. Here each
column's rank among its quantiles is taken, and the bits of the ranks are interleaved: rows near each
other on the curve are near in all columns, so a filter on any of them skips row groups.

Quantiles come from a sketch of all rows, one pass over the columns; the rows move once, by ranges of
the curve. Rows of one value of all columns share a place on the curve and may span files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK_BITS = 8
ACCURACY = 10_000


def as_number(df: DataFrame, name: str) -> Column:
    """A number that orders as the column does; text by its first seven bytes."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        digits = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(digits, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    raise ValueError(f"{name} has no order to rank by")


def quantile_edges(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> dict[str, list[float]]:
    """The values between equal shares of the rows, ``2**bits - 1`` a column; none for a column of NULLs."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(as_number(df, c), shares, ACCURACY).alias(c) for c in columns]).first()
    return {c: row[c] or [] for c in columns}


def rank(value: Column, edges: list[float], bits: int = RANK_BITS) -> Column:
    """How many edges are at or below a value, by halving; 0 for NULL."""
    if not edges:
        return F.lit(0)
    places, steps = F.array(*[F.lit(e) for e in edges]), F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def further(place: Column, step: Column) -> Column:
        return place + F.when(F.get(places, place + step - 1) <= value, step).otherwise(0)

    return F.aggregate(steps, F.lit(0), further)


def curve(df: DataFrame, columns: Sequence[str], edges: dict[str, list[float]], bits: int = RANK_BITS) -> Column:
    """The place of a row on the curve: the bits of its ranks, the highest of each column first."""
    if bits * len(columns) > 62:
        raise ValueError("too many columns for the bits of a rank")
    ranks = F.array(*[rank(as_number(df, c), edges[c], bits) for c in columns])

    def interleave(found: Column) -> Column:
        place = F.lit(0).cast("long")
        for bit in range(bits):
            for i in range(len(columns)):
                own = F.shiftright(F.get(found, i), bit).bitwiseAND(1).cast("long")
                place = place + F.shiftleft(own, bit * len(columns) + len(columns) - 1 - i)
        return place

    return F.get(F.transform(F.array(ranks), interleave), 0)


def write_interleaved(
    df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite", bits: int = RANK_BITS, files: int | None = None
) -> None:
    """Write parquet along the curve of the columns."""
    columns = list(columns)
    placed = df.withColumn("_curve", curve(df, columns, quantile_edges(df, columns, bits), bits))
    ranged = placed.repartitionByRange(*([files] if files else []), "_curve", *columns)
    ranged.sortWithinPartitions("_curve", *columns).drop("_curve").write.mode(mode).parquet(path)
