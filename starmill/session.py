"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on; a cluster's own spark-defaults may raise the sizes.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


SHUFFLE_BYTES = 128 * 1024 * 1024  # wanted size of one shuffle partition


def partitions_for(shuffled_bytes: int) -> int:
    """Shuffle partitions that keep each one near 128 MB; AQE merges what turns out smaller."""
    return max(200, -(-shuffled_bytes // SHUFFLE_BYTES))


def get_session(
    app: str = "starmill", master: str | None = None, shuffled_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Build (or fetch) a session with the defaults above; ``conf`` overrides them.

    ``shuffled_bytes`` is the size of the largest table that a job shuffles; it sets the
    number of shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(partitions_for(shuffled_bytes))} if shuffled_bytes else {}
    for key, value in {**SESSION_DEFAULTS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}  # application id -> temporary folder of a local session


def scratch_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets one temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="starmill-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_base(spark)}/starmill/{label}-{uuid.uuid4().hex}"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job go when the job ends, not when the driver happens to collect its garbage.

    For loads of many steps, each of which writes its result. A DataFrame on which a second action is run
    computes its shuffles again.
    """
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)
