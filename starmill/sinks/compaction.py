"""Many small files of a partitioned table to few (SNK-1, SNK-3).

An inventory of file sizes comes from the scan's own metadata, without reading a column. In each directory with several
small files those are read, written together below ``_compacted``, and moved into place; large
files and all other directories stay as they are. Running it again finds nothing to do.

The list of replaced files is written before the first of them goes. A run that fails while moving is finished by
the next one, or by ``finish_compaction``; until then rows may be seen twice, but none is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sinks import paths

TARGET_BYTES = 128 * 1024 * 1024
ROUND_FILES = 10_000  # files replaced together, so lists of names stay bounded


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """directory, file, bytes, rows of every data file of a table."""
    files = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    )
    counted = files.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.regexp_replace("file", "/[^/]*$", "").alias("directory"), "file", "bytes", "rows")


def small_files(sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """The files below half the target in directories that hold several of them."""
    small = sizes.filter(F.col("bytes") < target_bytes / 2)
    several = small.groupBy("directory").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return small.join(several, "directory", "left_semi")


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Move compacted files into place and remove those they replace; drop what is not complete."""
    work = f"{path}/_compacted"
    if paths.exists(spark, f"{work}/old/_SUCCESS"):  # written last, so the new files are complete
        for directory, names in sorted(paths.files_below(spark, f"{work}/new").items()):
            for name in names:
                paths.replace(spark, f"{work}/new/{directory}/{name}", f"{path}/{directory}/{name}")
        for row in spark.read.parquet(f"{work}/old").collect():  # names of one round
            paths.remove(spark, row["file"])
    paths.remove(spark, work)


def compact(
    spark: SparkSession, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES, round_files: int = ROUND_FILES,
) -> int:
    """Write the small files of each directory together; returns how many files were replaced.

    Files of a directory are dealt to bins of about the target, and each bin becomes a file. That at
    least halves their number, so rounds come to an end.
    """
    replaced = 0
    while True:
        finish_compaction(spark, path)
        found = small_files(file_sizes(spark, path), target_bytes)
        some = found.orderBy("directory", "file").limit(round_files).collect()
        last = some[-1]["directory"] if some else None
        if len(some) == round_files and some[0]["directory"] != last:
            some = [r for r in some if r["directory"] != last]  # may be cut; the next round takes it
        if len(some) < 2:
            return replaced
        bins, start = [], {}
        for r in some:
            before = start.get(r["directory"], 0)
            bins.append((r["file"], before // target_bytes))
            start[r["directory"]] = before + r["bytes"]
        files = [unquote(f) for f, _ in bins]
        schema, by = spark.read.parquet(path).schema, list(partition_by)
        rows = spark.read.schema(schema).option("basePath", path).parquet(*files)
        rows = rows.withColumn("_file", F.col("_metadata.file_path"))
        dealt = rows.join(F.broadcast(spark.createDataFrame(bins, "_file string, _bin long")), "_file").drop("_file")
        together = dealt.repartition(*by, "_bin").sortWithinPartitions(*by, "_bin", *sort_by).drop("_bin")
        together.write.partitionBy(*by).parquet(f"{path}/_compacted/new")
        spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.parquet(f"{path}/_compacted/old")
        finish_compaction(spark, path)
        replaced += len(files)
