"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Everything is computed in UTC: event days, months and batch dates never depend on the host.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Dedupe and window state of a big stream does not fit on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Commit the changes of a micro-batch, not a copy of the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_roots: dict[str, str] = {}


PARTITION_BYTES = 256 * 1024 * 1024
WIDEST_SHUFFLE = 50_000


def shuffle_width(input_bytes: int, least: int = 200) -> int:
    """Partitions for a shuffle of so many bytes: 256 MiB each, up to 50,000 of them. Beyond that,
    tracking the blocks costs more than spilling bigger partitions."""
    return min(max(least, -(-input_bytes // PARTITION_BYTES)), WIDEST_SHUFFLE)


@contextmanager
def shuffles_of(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Shuffle width of the jobs run, and of the streams first started, inside the block.

    A stream takes the width along into its checkpoint: its state lives in that many partitions.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside the block remove their shuffle files when they end, not when the driver
    happens to collect its garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def build_session(
    app_name: str = "costlake",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the lake's settings; ``conf`` adds to or overrides them.

    ``input_bytes`` sizes the shuffles of batch jobs for the biggest table; AQE merges what turns out
    smaller. A stateful stream keeps the width it was first started with, so set
    ``spark.sql.shuffle.partitions`` for its micro-batches before that first start.
    """
    if input_bytes is not None:
        conf.setdefault(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_width(input_bytes)),
        )
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the time zone on a session that was built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets one temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="costlake-")
    return _local_roots[context.applicationId]


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one; never reused, so a rerun cannot meet old files."""
    return f"{shared_folder(spark)}/costlake/{purpose}-{uuid.uuid4().hex}"
