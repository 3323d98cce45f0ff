"""Pick up new files only, once each (STR-1, STR-2).

Every stream here uses the ``availableNow`` trigger: it takes what is new since its
checkpoint, then stops, so any scheduler can start it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmill.sinks.hashed import merge_touched
from starmill.sinks.known_keys import append_unknown
from starmill.sinks.tables import append_new, upsert_latest_into


def new_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """A stream of the rows in files that were not seen before."""
    return spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True).load(path)


def append_stream(
    stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, order: Sequence[str] = ()
) -> StreamingQuery:
    """Append rows whose key the table lacks.

    The table itself is the memory of known keys: no state grows with the stream, and a batch
    that is repeated after a failure adds nothing.
    """

    def load(batch: DataFrame, _: int) -> None:
        batch.persist()  # looked at several times; its files are parsed once
        append_new(batch.sparkSession, batch, path, keys, order)
        batch.unpersist()

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream_within(
    stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, time: str, delay: str
) -> StreamingQuery:
    """Append rows, removing copies that arrive within ``delay`` of each other.

    State is kept for ``delay`` only; use ``append_stream`` when copies may come later.
    """
    unique = stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    return (
        unique.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def latest_stream(
    stream: DataFrame, table: str, base: str, keys: Sequence[str], order: str, changing: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Keep a catalog table at the latest value of its changing columns."""

    def load(batch: DataFrame, _: int) -> None:
        batch.persist()
        upsert_latest_into(batch.sparkSession, batch, table, base, keys, order, changing)
        batch.unpersist()

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_unknown_stream(
    stream: DataFrame, path: str, key: str, checkpoint: str, order: Sequence[str] = ()
) -> StreamingQuery:
    """As ``append_stream`` for an integer key; batches meet key bitmaps, not the table."""

    def load(batch: DataFrame, _: int) -> None:
        batch.persist()
        append_unknown(batch.sparkSession, batch, path, key, order)
        batch.unpersist()

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_touched_stream(
    stream: DataFrame, path: str, order: str, changing: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Keep a table made by ``create_hashed`` at the latest values; a batch rewrites the directories it touches."""

    def load(batch: DataFrame, _: int) -> None:
        merge_touched(batch.sparkSession, batch, path, order, changing)  # stages the batch itself

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
