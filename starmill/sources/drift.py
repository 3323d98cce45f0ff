"""JSON documents whose fields and types drift, staged without loss and reported on (PRJ-5, FIL-5).

Lines are parsed to variants, which keep whatever is there. ``stage_drifting`` gives the declared
columns; fields nobody declared, and values that don't fit their declared type, stay in ``_rest``
by path, and lines that are no JSON object in ``_bad_line``. ``drift_report`` counts per file
what differs from the declaration; one row per file, path and type of a task goes through its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REST, BAD_LINE = "_rest", "_bad_line"
FILE = "file_path"

_CLASSES = {
    "string": (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,), "number": (T.NumericType,), "array": (T.ArrayType,), "object": (T.StructType,),
}


def _structs(schema: T.StructType, at: str = "$") -> list[tuple[str, T.StructType]]:
    """Every struct of a declaration with its path; elements of arrays are not looked into."""
    found = [(at, schema)]
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            found += _structs(field.dataType, f'{at}["{field.name}"]')
    return found


def _leaves(schema: T.StructType, at: str = "$", dotted: str = "") -> list[tuple[str, str, T.DataType]]:
    """Path, dotted name and type of every declared field that is not a struct."""
    found = []
    for field in schema.fields:
        path, name = f'{at}["{field.name}"]', f"{dotted}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, path, f"{name}.")
        else:
            found.append((path, name, field.dataType))
    return found


def _dotted(at: str, end: str = "") -> str:
    """The dotted name of a path, with ``end`` after each part."""
    parts = at.split('"')[1::2]
    return "".join(f"{p}{end}" for p in parts) if end else ".".join(parts)


def _undeclared(at: str, struct: T.StructType, prefix: str) -> Column:
    """Path and JSON text of the fields of an object that its declaration lacks."""
    nothing = F.create_map().cast("map<string,variant>")
    fields = F.map_entries(F.coalesce(F.try_variant_get("doc", at, "map<string,variant>"), nothing))
    names = F.array(*[F.lit(f.name) for f in struct.fields])
    others = F.filter(fields, lambda field: ~F.array_contains(names, field["key"]))
    return F.transform(others, lambda field: F.struct(
        F.concat(F.lit(prefix), field["key"]).alias("key"), F.to_json(field["value"]).alias("value")
    ))


def _declared_class(kind: T.DataType) -> str:
    return next(name for name, types in _CLASSES.items() if isinstance(kind, types))


def read_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """line, file_path and doc (a variant, NULL where the line is no JSON object)."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    doc = F.try_parse_json("value")
    lines = lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias(FILE), doc.alias("doc"))
    whole = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT<"), F.lit(False))
    return lines.withColumn("doc", F.when(whole, F.col("doc")))


def _found_class(kind: Column) -> Column:
    """The class of a JSON value from its variant type."""
    return (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
        .otherwise("number")
    )


def present_fields(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """A row per line and field of its declared structs: line columns, path (dotted), found (its class), value, declared."""
    starts = F.array(*[
        F.struct(F.lit(path).alias("at"), F.lit(_dotted(path, ".")).alias("prefix"))
        for path, _ in _structs(schema)
    ])
    opened = lines.filter(F.col("doc").isNotNull()).withColumn("_start", F.explode(starts))
    opened = opened.withColumn("_object", F.expr("try_variant_get(doc, _start.at, 'variant')"))
    opened = opened.filter(F.coalesce(F.schema_of_variant("_object").startswith("OBJECT<"), F.lit(False)))
    fields = opened.lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("_object").outer()).toDF("_pos", "_key", "_value"))
    path = F.concat("_start.prefix", "_key")
    names = {n: _declared_class(kind) for _, n, kind in _leaves(schema)}
    for at, _ in _structs(schema)[1:]:
        names[_dotted(at)] = "object"
    known = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return fields.select(
        *lines.columns, path.alias("path"), _found_class(F.schema_of_variant("_value")).alias("found"),
        F.col("_value").alias("value"), F.try_element_at(known, path).alias("declared"),
    )


def stage_drifting(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared leaf columns by dotted name, ``_rest`` and ``_bad_line``; one row per line.

    ``_rest`` maps a path to the JSON text of a field that is not declared, or whose value does not fit the
    declared type; it is NULL where there is none.
    """
    values = {n: F.try_variant_get("doc", path, kind.simpleString()) for path, n, kind in _leaves(schema)}
    misfits, undeclared = [], []
    for at, struct in _structs(schema):
        prefix = _dotted(at, ".")
        for field in struct.fields:
            value = F.try_variant_get("doc", f'{at}["{field.name}"]', "variant")
            kind, name = F.schema_of_variant(value), f"{prefix}{field.name}"
            fits = kind.startswith("OBJECT<") if isinstance(field.dataType, T.StructType) else values[name].isNotNull()
            lost = value.isNotNull() & (kind != "VOID") & ~fits
            misfits.append(F.when(lost, F.struct(F.lit(name).alias("key"), F.to_json(value).alias("value"))))
        undeclared.append(_undeclared(at, struct, prefix))
    kept = F.concat(F.array_compact(F.array(*misfits)), *undeclared)
    return lines.select(
        *[value.alias(n) for n, value in values.items()],
        F.when(F.size(kept) > 0, F.map_from_entries(kept)).alias(REST),
        F.when(F.col("doc").isNull(), F.col("line")).alias(BAD_LINE),
    )


def drift_report(lines: DataFrame, schema: T.StructType, file: Column | None = None) -> DataFrame:
    """file, kind, path, found, n_lines: what each file holds beside its declaration.

    ``new`` fields are not declared, ``retyped`` ones hold values of another class than declared,
    ``absent`` ones are in no document of the file, and ``skipped`` lines are no JSON objects.
    JSON null fits every type. ``file`` groups the lines, by default by file path.
    """
    named = lines.withColumn("_file", F.col(FILE) if file is None else file)
    fields = present_fields(named.select("_file", "line", "doc"), schema)
    counted = fields.groupBy("_file", "path", "found", "declared").agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("declared").isNull(), "new").when(~F.col("found").isin("null") & (F.col("found") != F.col("declared")), "retyped")
    differing = counted.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    names = [n for _, n, _ in _leaves(schema)] + [_dotted(at) for at, _ in _structs(schema)[1:]]
    per_file = named.groupBy("_file").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("doc").isNull()).alias("bad")
    )
    declared = F.explode(F.array(*[F.lit(n) for n in names])).alias("path")
    held = counted.select("_file", "path").distinct()
    missing = per_file.filter(F.col("lines") > F.col("bad")).select("_file", declared, (F.col("lines") - F.col("bad")).alias("n"))
    missing = missing.join(held, ["_file", "path"], "left_anti")
    none = F.lit(None).cast("string")
    parts = [
        differing.select("_file", "kind", "path", "found", "n"),
        missing.select("_file", F.lit("absent"), "path", none, "n"),
        per_file.filter(F.col("bad") > 0).select("_file", F.lit("skipped"), none, none, "bad"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).toDF("file", "kind", "path", "found", "n_lines")
