"""Imputation, safe casts, date parsing and width rules (FN-6 to FN-11, SRC-8)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def or_default(value: Column, default: object) -> Column:
    """``default`` where the value is NULL."""
    return F.coalesce(value, F.lit(default))


def text_or_default(value: Column, default: str = "N/A") -> Column:
    """``default`` where the text is NULL or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def safe_cast(value: Column, type_name: str) -> Column:
    """Cast that gives NULL instead of failing on text that does not fit."""
    return value.try_cast(type_name)


def parse_date(text: Column, fmt: str = "yyyyMMdd") -> Column:
    """Text to date; NULL when the text does not match the format."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def parse_timestamp(text: Column) -> Column:
    """ISO-like text to a zone-free timestamp, NULL when it is not one."""
    return text.try_cast("timestamp_ntz")


def flag(text: Column) -> Column:
    """'1' is true, anything else that is present false, absent NULL."""
    return text == "1"


def fit_widths(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Cut each named column to its declared number of characters."""
    cut = {c: F.left(F.col(c), F.lit(n)) for c, n in widths.items() if c in df.columns}
    return df.withColumns(cut) if cut else df
