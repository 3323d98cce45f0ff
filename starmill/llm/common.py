"""Tables, written intermediate results and small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable:
    """Register a query, with its SQL where SQL can express it."""

    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage where all executors can read it.

    Also fixes what a task run again could number or order differently, such as
    ``monotonically_increasing_id``: only one attempt of each task is committed.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row() -> Column:
    """All columns of a row in one struct, so that helper columns cannot clash with them."""
    return F.struct("*").alias("row")


def restored(df: DataFrame, like: DataFrame, **replaced: Column) -> list[Column]:
    """The columns of ``like`` out of ``row``, some of them replaced."""
    row = [f.name for f in df.schema["row"].dataType.fields]
    return [replaced.get(c, F.col("row").getField(c)).alias(c) for c in row if c in like.columns]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc_mod(column: str, n: int) -> Column:
    """CRC-32 of a number written as text, modulo ``n``; 0 for NULL."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n)), F.lit(0))


def hash64(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit integers so that every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and the n+1 offsets of its rows; NULL is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``limit`` bytes each; a longer row is a run of its own."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(n, max(end, start + 1))
        yield start, end
        start = end


def in_batches(function: Callable[[pa.RecordBatch], Any]) -> Callable:
    """A function on one Arrow batch as a function for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return run
