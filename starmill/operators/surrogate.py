"""Dense surrogate numbers without a single-partition window (KEY-3, KEY-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in 33 bits


def dense_ids(df: DataFrame, order: list[str], name: str, start: int = 1, partitions: int | None = None) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the order of ``order``, a unique key.

    Rows are range-partitioned (AQE sizes the partitions unless their number is given) and
    sorted inside each; the partition number and the place in it are written to the shared
    scratch folder. The second pass adds to each place
    the number of rows in earlier partitions, a table of one row per partition.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    path = scratch_path(spark, "dense-ids")
    raw = F.monotonically_increasing_id()
    (
        ranged.sortWithinPartitions(*order)
        .withColumn("_raw", raw)
        .select(
            *df.columns,
            F.shiftright("_raw", _ROW_BITS).cast("int").alias("_part"),
            F.col("_raw").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
        )
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # the running total is over one row per partition: their number is a setting, not data
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_place") + F.lit(start)).alias(name), *df.columns
    )


def unordered_ids(df: DataFrame, name: str) -> DataFrame:
    """Unique but gapped numbers, different on every run; prefer a content key."""
    return df.withColumn(name, F.monotonically_increasing_id())
