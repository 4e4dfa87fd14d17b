"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings. All can be changed on a live session, so `prepare` also works on one that
# somebody else built. Partition counts are left to the cluster: AQE coalesces and splits them.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Compressed size of a stored table up to which it is sent to every executor instead of
    # shuffling the rows it is joined to: twenty years of hourly prices of forty countries fit.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Only for new sessions: do not record a Python stack with every column expression. Building the
# long CASE expressions of this library takes a third of the time without it.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "gridlake", master: str | None = None, **settings: str) -> SparkSession:
    """A new session; pass `master` only for local runs, a cluster sets its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **STATIC, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def planned_bytes(*frames) -> int:
    """Bytes that the planner expects to read for the frames: for scans of files, their size."""
    sizes = [int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in frames]
    # A frame of unknown size is estimated as the largest possible one.
    return sum(size for size in sizes if size < 1 << 60)


@contextmanager
def sized_shuffles(spark: SparkSession, stored_bytes: int) -> Iterator[int]:
    """`size_shuffles` for the time of a block; the session's own setting comes back after it."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        yield size_shuffles(spark, stored_bytes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def size_shuffles(spark: SparkSession, stored_bytes: int, expansion: int = 4, target: int = 256 << 20) -> int:
    """Raise the shuffle partition count so that a shuffle of the given tables spills little.

    AQE can merge partitions that turn out small, but it cannot make more than were planned, and
    the default of 200 would put hundreds of gigabytes into one. Stored data grows when it is
    decompressed, hence `expansion`. A larger configured count is kept.
    """
    wanted = stored_bytes * expansion // target + 1
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)
