"""Parquet and CSV writers, layouts and load modes (SNK-1 to SNK-12, LAY-1 to LAY-4)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.dedupe import first_of_repeated, last_per_key, repeated_keys
from starmill.operators.joins import fits_broadcast, may_have_hot_keys
from starmill.operators.upserts import absent_rows, merge_latest, new_rows
from starmill.session import scratch_path
from starmill.sinks import paths

CODEC = "zstd"  # of loaded tables: keys that are digests don't shrink without entropy coding


class RowCount:
    """The number of rows that pass through a DataFrame when it is written; 0 if it never is."""

    def __init__(self):
        self._observation, self._used = Observation(), False

    def on(self, df: DataFrame) -> DataFrame:
        """The same rows, counted by the next action on them alone."""
        self._used = True
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> int:
        if not self._used:
            return 0
        try:
            return self._observation.get["rows"]
        except Py4JJavaError:  # no metric: the planner saw while running that there are no rows, and cut the count
            return 0


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite",
    partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None, codec: str | None = None,
) -> None:
    """Write parquet, optionally in partition directories and sorted inside each file.

    The rebalance hint gathers each directory's rows into few files; AQE splits a directory
    that is too large for one task and merges small ones. Sorting narrows the row-group
    ranges that later filters are checked against. ``finish`` makes the columns that follow from
    others of their row, after the rows have moved.
    """
    by = list(partition_by)
    if by:
        df = df.hint("rebalance", *by)
    if finish:
        df = finish(df)
    if by or sort_by:
        df = df.sortWithinPartitions(*by, *[c for c in sort_by if c not in by])
    writer = df.write.mode(mode)
    writer = writer.option("compression", codec) if codec else writer
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_clustered(df: DataFrame, path: str, partition_key: Sequence[str], clustering: Sequence[str] = ()) -> None:
    """Write rows of one key next to each other, in clustering order.

    Range partitioning on key and clustering columns lets a key with very many rows span
    several tasks and files without losing the order.
    """
    order = [*partition_key, *clustering]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: Sequence[str], buckets: int) -> None:
    """Register a table bucketed and sorted by the join key, so joins on it need no shuffle.

    One task reads a whole bucket, so a key that alone holds more than the rows of a mean bucket
    is refused: write such a table with ``write_clustered`` and join it with
    ``lookup_join``. Keys of a single row are never refused.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    limit = max(1, total / buckets)
    hot = counts.filter(F.col("_n") > limit).select(*key).limit(buckets).collect()  # fewer keys than buckets
    if hot:
        raise ValueError(f"{len(hot)} keys of {table} hold too many rows for one bucket, such as {tuple(hot[0])}")
    (
        df.repartition(buckets, *key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *key)
        .sortBy(*key)
        .saveAsTable(table)
    )


def load_partitions(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], sort_by: Sequence[str] = (),
    count: RowCount | None = None, unique: bool = False,
    complete: Callable[[DataFrame], DataFrame] | None = None, finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add the rows whose key their partition does not hold yet; nothing stored is lost.

    Late rows join the partition they belong to, and loading a batch again changes nothing. Only the
    partitions named in the batch are read, so a key must determine its partition. Returns those
    partitions, one row each; see ``in_partitions``.

    The batch is computed once and kept until it is loaded. With ``complete``, which makes whole rows of
    those to add, it is read where it lies instead: give a plain selection from stored rows that has the keys
    and partitions. ``unique`` tells that no key is twice in the whole rows; ``finish`` is explained at
    ``write_table``.
    """
    spark, keys, by = df.sparkSession, list(keys), list(partition_by)
    staged, listed = scratch_path(spark, "batch"), scratch_path(spark, "partitions")
    if complete is None:
        df.write.option("compression", CODEC).parquet(staged)
        df = spark.read.schema(df.schema).parquet(staged)
    df.select(*by).distinct().write.parquet(listed)
    named = spark.read.schema(df.select(*by).schema).parquet(listed)
    if paths.exists(spark, path) and paths.folders(spark, path):
        stored = spark.read.schema(df.select(*keys, *[c for c in by if c not in keys]).schema).parquet(path)
        added = absent_rows(in_partitions(stored, named), df, keys)
    else:  # nothing is stored yet
        added = df
    repeated = None if unique else repeated_keys(added, keys)
    whole = first_of_repeated(complete(added) if complete else added, keys, repeated)
    ensure_table(spark, path, (finish(whole) if finish else whole).schema, by)
    write_table(count.on(whole) if count else whole, path, "append", by, sort_by, finish, CODEC)
    paths.remove(spark, staged)
    return named


def in_partitions(table: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of a partitioned table in the given partitions; the other directories are not read.

    Equal values prune directories while the query runs, however many they are; a NULL partition is
    looked for only if it is asked for.
    """
    by = named.columns
    missing = reduce(or_, [F.col(c).isNull() for c in by])
    marks = F.broadcast(named) if fits_broadcast(named) else named
    rows = table.join(marks.filter(~missing), by, "left_semi")
    if named.filter(missing).isEmpty():
        return rows
    other = named.filter(missing).select(*[F.col(c).alias(f"_part_{c}") for c in by])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_part_{c}")) for c in by])
    return rows.unionByName(table.filter(missing).join(other, same, "left_semi"))


# quotes are doubled inside fields, and text keeps its leading and trailing blanks
_WHOLE_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_pipe_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``|`` separated, without header."""
    df.write.mode(mode).options(**_WHOLE_TEXT).option("sep", "|").option("header", False).csv(path)


def write_slim_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Chosen columns with a header, quoted only where needed."""
    df.select(*columns).write.mode("overwrite").options(**_WHOLE_TEXT).option("header", True).csv(path)


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> DataFrame:
    """The table at ``path``, made empty first when nothing is there."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def load_fact(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a fact table; columns are matched by name."""
    if schema is not None:
        df = df.select(*schema.names)
    write_table(df, path, mode="append", partition_by=partition_by)


def load_dimension(
    df: DataFrame, path: str, mode: str = "overwrite",
    partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
) -> None:
    """Load a dimension: ``overwrite`` empties it first, ``insert`` appends."""
    modes = {"overwrite": "overwrite", "insert": "append"}
    write_table(df, path, mode=modes[mode], partition_by=partition_by, sort_by=sort_by)


def append_new(
    spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (),
    partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), count: RowCount | None = None,
) -> None:
    """Append the batch rows whose key the table does not hold yet (insert or do nothing)."""
    existing = ensure_table(spark, path, batch.schema)
    added = new_rows(existing, batch, list(keys), list(order)).select(*batch.columns)
    write_table(count.on(added) if count else added, path, mode="append", partition_by=partition_by, sort_by=sort_by)


def publish(spark: SparkSession, table: str, path: str) -> None:
    """Point a catalog table at a newly written folder; readers switch in one step."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet")


def refresh_table(spark: SparkSession, table: str) -> None:
    """Let a catalog table see files and partitions that were written to its folder."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def upsert_latest_into(
    spark: SparkSession, batch: DataFrame, table: str, base: str,
    keys: Sequence[str], order: str, changing: Sequence[str], count: RowCount | None = None,
) -> None:
    """Merge the batch into a catalog table whose folders lie under ``base``; see ``merge_latest``.

    The merged table is written to a folder of its own and then published, so the previous
    state stays whole until the switch, and merging a batch again changes nothing.
    """
    known = spark.catalog.tableExists(table)
    existing = spark.table(table) if known else spark.createDataFrame([], batch.schema)
    path = f"{base}/{uuid.uuid4().hex}"
    merged = merge_latest(existing, batch, list(keys), order, list(changing))
    write_table(count.on(merged) if count else merged, path, sort_by=keys)
    publish(spark, table, path)


def upsert_last_write(
    df: DataFrame, path: str, partition_key: Sequence[str], clustering: Sequence[str], order: Sequence[str],
    distinct: bool = False,
) -> None:
    """Write a query-first table: one row per primary key, the last written one.

    Rows are moved once: ranges of the whole key hold all rows of a key, so the last one is chosen
    where the file is written. Only if a key may be hot are its rows first brought down in each task.
    ``distinct`` drops rows that are equal in all columns before the choice.
    """
    keys = [*partition_key, *clustering]
    hot = may_have_hot_keys(df, keys)
    rows = df if hot else df.repartitionByRange(*keys)
    rows = last_per_key(rows.distinct() if distinct else rows, keys, list(order))
    if hot:
        write_clustered(rows, path, partition_key, clustering)
    else:
        rows.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
