"""Nested documents of any depth to flat tables (NST-1).

The schema is walked once. Structs become columns with dotted names; each array becomes a child
table with the key of its parent row and its place in the array, and so do the arrays inside it. Maps
are arrays of key and value. All tables are projections of the given rows, so nothing is shuffled,
and only the columns a table needs are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUE = "value"  # name of the elements of an array without fields


def _walk(column: Column, name: str, kind: T.DataType, sep: str, fields: dict, arrays: dict) -> None:
    """Collect leaf columns and arrays below a column by dotted name."""
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            inner = f"{name}{sep}{field.name}" if name else field.name
            _walk(column.getField(field.name), inner, field.dataType, sep, fields, arrays)
        return
    found = arrays if isinstance(kind, (T.ArrayType, T.MapType)) else fields
    if name in fields or name in arrays:
        raise ValueError(f"two columns would be named {name}")
    found[name] = (column, kind)


def relational(df: DataFrame, keys: Sequence[str], name: str = "root", sep: str = ".") -> dict[str, DataFrame]:
    """Every table of the nested rows by name: ``name`` itself, ``name.array``, ``name.array.inner``, ...

    ``keys`` are top-level columns that tell the rows apart. A child table holds them, a place
    (``array#``, from 0) for each array above it, and the dotted fields of its elements; an array of plain
    values has the column ``value``. NULL and empty arrays have no rows; a NULL element keeps its row.
    """
    keys, tables = list(keys), {}

    def build(rows: DataFrame, table: str, above: list[str], element: str | None, kind: T.DataType) -> None:
        fields: dict[str, tuple[Column, T.DataType]] = {}
        arrays: dict[str, tuple[Column, T.DataType]] = {}
        if element is None:
            for field in kind.fields:
                if field.name not in above:
                    _walk(F.col(f"`{field.name}`"), field.name, field.dataType, sep, fields, arrays)
        else:
            plain = not isinstance(kind, T.StructType)
            _walk(F.col(element), VALUE if plain else "", kind, sep, fields, arrays)
        if clash := set(fields) & set(above):
            raise ValueError(f"columns {sorted(clash)} of {table} are named like its key")
        own = [F.col(f"`{c}`") for c in above]
        tables[table] = rows.select(*own, *[column.alias(c) for c, (column, _) in fields.items()])
        for inner, (column, array) in arrays.items():
            if isinstance(array, T.MapType):
                column = F.map_entries(column)
                item = T.StructType().add("key", array.keyType).add("value", array.valueType)
            else:
                item = array.elementType
            place = f"{inner}#" if element is None else f"{above[-1].removesuffix('#')}{sep}{inner}#"
            children = rows.select(*own, F.posexplode(column).alias(place, "_element"))
            build(children, f"{table}{sep}{inner}", [*above, place], "_element", item)

    build(df, name, keys, None, df.schema)
    return tables
