"""Epoch conversion and calendar parts (FN-1 to FN-5).

Times are kept zone-free (``timestamp_ntz``), so no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_millis(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, milliseconds kept."""
    return F.timestamp_add("MILLISECOND", ms.cast("bigint"), F.expr(_EPOCH))


def epoch_seconds(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds."""
    return F.date_trunc("SECOND", epoch_millis(ms)).cast("timestamp_ntz")


def to_epoch_millis(ts: Column) -> Column:
    """Timestamp to epoch milliseconds, sub-millisecond digits cut."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts)


def weekday(ts: Column, convention: str = "monday0") -> Column:
    """Day of week: ``monday0`` (0..6), ``sunday0`` (0..6) or ``sunday1`` (1..7)."""
    if convention == "monday0":
        return F.weekday(ts)
    if convention == "sunday0":
        return F.dayofweek(ts) - 1
    if convention == "sunday1":
        return F.dayofweek(ts)
    raise ValueError(f"unknown weekday convention {convention!r}")


def time_parts(ts: Column, convention: str = "monday0") -> list[Column]:
    """hour, day, ISO week, month, year and weekday of a timestamp."""
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekday(ts, convention).alias("weekday"),
    ]
