"""File readers with explicit schemas (SRC-1 to SRC-10).

One reader call covers all files, so listing, splitting and parsing are one distributed job. Files
may be compressed with gzip; such a file is read by one task.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.clean import fit_widths
from starmill.functions.nested import pick_paths


BAD_ROW = "_bad_row"


def _reader(spark: SparkSession, schema: T.StructType, on_bad: str) -> DataFrameReader:
    """A reader to which a broken row is an error (``fail``) or a row with its text in ``_bad_row`` (``keep``)."""
    if on_bad == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST")
    if on_bad == "keep":
        fields = [*schema.fields, T.StructField(BAD_ROW, T.StringType())]
        return spark.read.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", BAD_ROW)
    raise ValueError(f"on_bad is 'fail' or 'keep', not {on_bad!r}")


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(whole rows, broken rows) of a table that was read with ``on_bad="keep"`` and stored.

    Spark refuses to look at the text of broken rows alone in files that it is still parsing.
    """
    return df.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW), df.filter(F.col(BAD_ROW).isNotNull())


def read_json_tree(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.{json,json.gz}", on_bad: str = "fail"
) -> DataFrame:
    """JSON lines from every matching file below ``path``, however deep.

    A line that isn't JSON of the schema's types is an error, or kept in ``_bad_row``.
    """
    return (
        _reader(spark, schema, on_bad)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(path)
    )


def count_files(df: DataFrame) -> DataFrame:
    """Rows and files behind a file-based DataFrame: n_files, n_rows."""
    per_file = df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count("file").alias("n_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def read_csv_tree(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",",
    pattern: str = "*.{csv,csv.gz}", multi_line: bool = False, on_bad: str = "fail",
) -> DataFrame:
    """All CSV files below ``path`` as one table; quotes inside fields are doubled.

    A header that doesn't name the columns of ``schema`` in their order is an error, so no column
    is taken for another. So is a row with other fields than the schema's, unless ``on_bad`` keeps it.
    """
    return (
        _reader(spark, schema, on_bad)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("sep", sep)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(path)
    )


def read_documents(spark: SparkSession, path: str, schema: T.StructType, array: str = "results") -> DataFrame:
    """One row per element of the ``array`` of each JSON document; absent fields are NULL.

    A file holds one document and is read by one task; a broken document is an error.
    """
    documents = (
        _reader(spark, schema, "fail")
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )
    return documents.select(F.inline(array))


def read_pipe_csv(
    spark: SparkSession, path: str, schema: T.StructType, widths: Mapping[str, int] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Headerless ``|`` files into typed columns, text cut to its declared width.

    Widths count characters. ``multi_line`` accepts line breaks inside quotes, at the price of
    one task per file.
    """
    df = read_csv_tree(spark, path, schema, header=False, sep="|", pattern="*", multi_line=multi_line)
    return fit_widths(df, widths or {})


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet written earlier; a schema keeps the types of partition columns."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def render_path(template: str, run_date: date | datetime) -> str:
    """Fill a key template such as ``log/{execution_date.year}/{execution_date.month}``."""
    return template.format(execution_date=run_date)


def stage(
    spark: SparkSession, path_template: str, run_date: date | datetime, schema: T.StructType,
    fmt: str = "csv", sep: str = ",", header: bool = True, mapping: Mapping[str, str] | None = None,
    to: str | None = None, on_bad: str = "fail", count=None,
) -> DataFrame:
    """Load one run's raw files; with ``to``, clear that staging table and fill it first.

    ``count``, a ``RowCount``, then counts the rows as they are written.

    ``mapping`` is ``{column: dotted source path}``; without it columns match by name.
    ``header`` applies to CSV only. Broken rows are errors, or with ``on_bad="keep"`` staged in
    ``_bad_row``: see ``split_bad_rows``.
    """
    path = render_path(path_template, run_date)
    if fmt == "json":
        raw = read_json_tree(spark, path, schema, on_bad=on_bad)
    elif fmt == "csv":
        raw = read_csv_tree(spark, path, schema, header=header, sep=sep, on_bad=on_bad)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    if mapping and on_bad == "keep":
        mapping = {**mapping, BAD_ROW: BAD_ROW}
    staged = pick_paths(raw, mapping) if mapping else raw
    if to is None:
        return staged
    (count.on(staged) if count else staged).write.mode("overwrite").option("compression", "zstd").parquet(to)
    return spark.read.schema(staged.schema).parquet(to)
