"""Tables laid in directories by a hash of their key: a merge rewrites the directories it touches (UPS-2, STR-2).

``merge_latest`` alone gives the whole table again. Here row and key decide the directory, so the
keys of a batch name the directories that can change. Only those are read, merged and replaced; the files
of all others stay as they are, and no second copy of the table is left behind.

A merge writes its directories to ``_pending`` inside the table first. They are moved into place
once all are written. A merge that fails before that has changed nothing, and what one that fails
while moving has left in ``_pending`` is moved by the next merge or by ``finish_merge``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.dedupe import latest_attributes
from starmill.operators.upserts import fold_latest
from starmill.session import scratch_path
from starmill.sinks import paths
from starmill.sinks.tables import write_table

DIRECTORY = "hash_directory"
DIRECTORY_BYTES = 512 * 1024 * 1024


def directories_for(table_bytes: int) -> int:
    """Directories that keep each one near 512 MB."""
    return max(1, -(-table_bytes // DIRECTORY_BYTES))


def directory_of(keys: Sequence[str], directories: int) -> Column:
    """The directory of a row; NULL is a key like any other."""
    return F.pmod(F.xxhash64(*keys), F.lit(directories)).cast("int")


def create_hashed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], directories: int) -> None:
    """An empty table; its keys and number of directories are kept beside its data. An existing one stays."""
    layout = f"{path}/_layout"
    if not paths.exists(spark, f"{layout}/_SUCCESS"):
        paths.make(spark, path)
        kept = spark.createDataFrame([(list(keys), directories, schema.json())], "keys array<string>, directories int, schema string")
        kept.coalesce(1).write.mode("overwrite").parquet(layout)


def _layout(spark: SparkSession, path: str) -> tuple[list[str], int, T.StructType]:
    row = spark.read.parquet(f"{path}/_layout").first()
    return list(row["keys"]), row["directories"], T.StructType.fromJson(json.loads(row["schema"]))


def read_hashed(spark: SparkSession, path: str, with_directory: bool = False) -> DataFrame:
    """The rows of the table; ``with_directory`` adds the partition column to filter by."""
    _, _, schema = _layout(spark, path)
    whole = T.StructType([*schema.fields, T.StructField(DIRECTORY, T.IntegerType())])
    df = spark.read.schema(whole).parquet(path)
    return df if with_directory else df.drop(DIRECTORY)


def finish_merge(spark: SparkSession, path: str) -> None:
    """Move what a merge has written into place, or drop what one has not finished writing."""
    pending = f"{path}/_pending"
    if not paths.exists(spark, pending):
        return
    if paths.exists(spark, f"{pending}/_SUCCESS"):
        for name in paths.folders(spark, pending):  # one entry per directory of the batch
            paths.replace(spark, f"{pending}/{name}", f"{path}/{name}")
    paths.remove(spark, pending)


def merge_touched(spark: SparkSession, batch: DataFrame, path: str, order: str, changing: Sequence[str]) -> list[int]:
    """Merge a batch as ``merge_latest`` does, directory by directory; returns the directories it touched.

    Merging a batch again changes no row.
    """
    finish_merge(spark, path)
    keys, directories, schema = _layout(spark, path)
    fixed = [c for c in schema.names if c not in keys and c not in changing and c != order]
    staged = scratch_path(spark, "merge")
    incoming = latest_attributes(batch.select(*schema.names), keys, order, list(changing), fixed)
    incoming.withColumn(DIRECTORY, directory_of(keys, directories)).write.parquet(staged)
    incoming = spark.read.parquet(staged)
    touched = sorted(r[0] for r in incoming.select(DIRECTORY).distinct().collect())  # directories at most
    if touched:
        stored = read_hashed(spark, path, with_directory=True).filter(F.col(DIRECTORY).isin(touched))
        rows = stored.withColumn("_batch", F.lit(0)).unionByName(incoming.withColumn("_batch", F.lit(1)))
        # a key determines its directory, so grouping by both moves rows as grouping by the key does
        merged = fold_latest(rows, [DIRECTORY, *keys], order, list(changing), fixed)
        write_table(merged.select(*schema.names, DIRECTORY), f"{path}/_pending", partition_by=[DIRECTORY], sort_by=keys)
        finish_merge(spark, path)
    paths.remove(spark, staged)
    return touched
