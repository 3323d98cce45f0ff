"""Flattening of nested records (NST-1 to NST-4, SRC-6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pick_paths(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """One flat column per entry of ``{target name: dotted source path}``, in that order."""
    return df.select(*[F.col(path).alias(name) for name, path in mapping.items()])


def pick_json_paths(text: Column, mapping: Mapping[str, str]) -> list[Column]:
    """Columns read from JSON text by ``{target name: JSON path}``."""
    return [F.get_json_object(text, path).alias(name) for name, path in mapping.items()]


def flatten_one_level(df: DataFrame, sep: str = "_") -> DataFrame:
    """Replace each struct column by its fields, one level deep, as ``outer<sep>inner``."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            columns += [
                F.col(f"`{field.name}`.`{inner}`").alias(f"{field.name}{sep}{inner}")
                for inner in field.dataType.names
            ]
        else:
            columns.append(F.col(f"`{field.name}`"))
    return df.select(*columns)


def explode_structs(df: DataFrame, array: str, carry: list[str]) -> DataFrame:
    """One row per struct in ``array``, its fields as columns, with the parent's columns."""
    return df.select(*carry, F.inline(F.col(array)))


def explode_values(df: DataFrame, array: str, name: str, carry: list[str]) -> DataFrame:
    """One row per value; an empty or missing array keeps one row holding NULL."""
    return df.select(*carry, F.explode_outer(F.col(array)).alias(name))
