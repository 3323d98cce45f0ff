"""Insert if absent with the known keys as bitmaps beside the table (UPS-1, STR-1).

``append_new`` reads the key column of the whole table for every batch. Here the integer keys of a
table are kept as bitmaps of 32,768 keys each: one bit a key, a few bytes where keys lie close. A batch is
compared with the bitmaps of its own blocks; the table itself is only appended to.

Rows are appended before their bits. A mark beside the bitmaps stands while a load runs; where a load
finds it, one before it has failed, and the bitmaps are built again from the table's key column.
Bitmaps of one block from several loads are united when they are read, and written united once
there are many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.dedupe import first_per_key
from starmill.operators.joins import fits_broadcast
from starmill.session import scratch_path
from starmill.sinks import paths
from starmill.sinks.tables import ensure_table, write_table

NULL_BLOCK = -(2**63)  # no key's block; NULL is a key like any other
UNITE_AFTER = 16  # bitmaps a block has on average before they are united
SCHEMA = "block long, bits binary"


def _block(key: str) -> Column:
    return F.coalesce(F.bitmap_bucket_number(F.col(key).cast("long")), F.lit(NULL_BLOCK))


def _bit(key: str) -> Column:
    return F.coalesce(F.bitmap_bit_position(F.col(key).cast("long")), F.lit(0).cast("long"))


def _has(bits: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def key_bitmaps(rows: DataFrame, key: str) -> DataFrame:
    """block, bits: the keys of the rows."""
    placed = rows.select(_block(key).alias("block"), _bit(key).alias("_bit"))
    return placed.groupBy("block").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def unite(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def unknown_rows(batch: DataFrame, key: str, bitmaps: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key of the batch that the bitmaps do not hold.

    Rows meet the bitmap of their block, 32,768 keys at most, so no group is large.
    """
    candidates = first_per_key(batch, [key], list(order)).withColumn("_block", _block(key))
    blocks = batch.select(_block(key).alias("block")).distinct()
    asked = F.broadcast(blocks) if fits_broadcast(blocks) else blocks
    known = unite(bitmaps.join(asked, "block", "left_semi")).withColumnRenamed("bits", "_bits")
    met = candidates.join(known.withColumnRenamed("block", "_block"), "_block", "left")
    return met.filter(~_has(F.col("_bits"), _bit(key))).select(*batch.columns)


def _bitmaps_at(path: str) -> str:
    return f"{path.rstrip('/')}_keys"


def read_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(_bitmaps_at(path))


def _put(spark: SparkSession, bitmaps: DataFrame, path: str) -> None:
    """Write bitmaps in the place of those there."""
    fresh = f"{_bitmaps_at(path)}_new"
    bitmaps.write.mode("overwrite").parquet(fresh)
    paths.replace(spark, fresh, _bitmaps_at(path))


def ensure_bitmaps(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """The bitmaps of a table, built from its key column if there are none or a load has failed."""
    table = ensure_table(spark, path, schema)
    mark = f"{_bitmaps_at(path)}_open"
    if paths.exists(spark, mark) or not paths.exists(spark, f"{_bitmaps_at(path)}/_SUCCESS"):
        _put(spark, key_bitmaps(table, key), path)
        paths.remove(spark, mark)
    return read_bitmaps(spark, path)


def append_unknown(spark: SparkSession, batch: DataFrame, path: str, key: str, order: Sequence[str] = ()) -> None:
    """Append the batch rows whose integer key the table does not hold yet."""
    if not isinstance(batch.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key} is not an integer column; use append_new")
    bitmaps = ensure_bitmaps(spark, path, key, batch.schema)
    staged = scratch_path(spark, "unknown")
    unknown_rows(batch, key, bitmaps, order).write.parquet(staged)
    added = spark.read.schema(batch.schema).parquet(staged)
    mark = f"{_bitmaps_at(path)}_open"
    paths.make(spark, mark)
    write_table(added, path, mode="append")
    key_bitmaps(added, key).write.mode("append").parquet(_bitmaps_at(path))
    written = read_bitmaps(spark, path)
    n, blocks = written.agg(F.count(F.lit(1)), F.approx_count_distinct("block")).first()
    if n > UNITE_AFTER * blocks:
        _put(spark, unite(written), path)
    paths.remove(spark, mark)
    paths.remove(spark, staged)
