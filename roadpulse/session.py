"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State on local disk instead of the heap; commits upload what changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "roadpulse", master: str | None = None, **conf: str) -> SparkSession:
    """Session for the jobs in ``plans``.  Shuffle width is left to AQE, which
    starts from the configured partition count and coalesces or splits."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in STATE_STORE.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, for a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    return spark


def state_width(spark: SparkSession) -> int:
    """State partitions for a streaming query: one per core, but not more than
    ``spark.sql.shuffle.partitions``.

    Each of them opens a store and a Python worker in every batch, however few
    rows there are, and writes files of its own.  With dynamic allocation the
    cores are not known at the start, and the setting holds as it is."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return configured
    return min(configured, spark.sparkContext.defaultParallelism)


@contextmanager
def whole_snapshots(spark: SparkSession, wanted: bool = True) -> Iterator[None]:
    """Streaming queries started inside store their state as files, not as a log
    of changes.

    A log keeps commits short where batches are small and many.  A run that works
    off a backlog in a few large batches writes every row into it, and each
    restart reads and applies all of it before the first row."""
    key = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = spark.conf.get(key)
    if wanted:
        spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def empty_batches(spark: SparkSession, wanted: bool = True) -> Iterator[None]:
    """Streaming queries started inside run batches without rows, which Spark
    adds whenever the watermark moves, only if ``wanted``."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    if not wanted:
        spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def state_partitions(spark: SparkSession, number: int | None = None) -> Iterator[int]:
    """Streaming queries built and started inside have ``number`` state
    partitions (None: ``state_width``); a query with a checkpoint keeps those it
    has.  A query copies the settings at its start, so wait for it outside."""
    key = "spark.sql.shuffle.partitions"
    before, number = spark.conf.get(key), number or state_width(spark)
    spark.conf.set(key, number)
    try:
        yield number
    finally:
        spark.conf.set(key, before)


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder path under the cluster's shared checkpoint folder.

    The folder is the one named by ``spark.checkpoint.dir``.  Only a local
    session may fall back to a temporary folder: on a cluster executors would
    each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="roadpulse-")
    return f"{base.rstrip('/')}/roadpulse/{name}-{uuid.uuid4().hex[:12]}"
