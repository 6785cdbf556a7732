"""Keyed views as Parquet: an idempotent change log, read as latest row per key.

A micro-batch writes its rows under ``log/batch_id=N`` and overwrites that
folder when it is replayed.  A view recomputed as a whole is a plain table, see
``write_view``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.functions.times import event_time

# Fixed value: seconds a vehicle stays on the live point-of-interest view.
POI_TTL_SECONDS = 120


def path_exists(spark: SparkSession, path: str) -> bool:
    """Any error but a missing path is raised."""
    try:
        spark.read.text(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``, or None if the path does not exist.  Any other
    error is raised."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def upsert_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Record the rows of one micro-batch.  Usable from ``foreachBatch``.

    A batch without rows leaves no folder, apart from the first one, which gives
    the view its columns.  The rows are kept for the two looks at them."""
    kept = rows.persist()
    try:
        if batch_id == 0 or not kept.isEmpty():
            kept.write.mode("overwrite").parquet(f"{path}/log/batch_id={batch_id}")
    finally:
        kept.unpersist()


def latest_per_key(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write per key.  ``max_by`` combines before the shuffle, so a key
    rewritten in every batch does not pile up in one task."""
    rest = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    return changes.groupBy(*keys).agg(newest).select(*keys, "row.*").select(changes.columns)


def latest_per_key_ranked(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same by ranking.  Sorts every version of a key, so it suits views
    whose rows hold columns that cannot be aggregated."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return changes.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All rows ever written to the view, with ``batch_id``."""
    log = read_if_exists(spark, f"{path}/log")
    if log is None:
        raise FileNotFoundError(f"no view at {path}")
    return log


def read_view(spark: SparkSession, path: str, keys: list[str], time_column: str = "time_stamp") -> DataFrame:
    """Current rows of a view: one per key, last batch wins, then last time."""
    changes = read_changes(spark, path)
    return latest_per_key(changes, keys, ["batch_id", time_column]).drop("batch_id")


def with_expiry(rows: DataFrame, ttl_seconds: int = POI_TTL_SECONDS, time_column: str = "time_stamp") -> DataFrame:
    return rows.withColumn(
        "expires_at", F.col(time_column) + F.make_dt_interval(secs=F.lit(ttl_seconds))
    )


def unexpired(rows: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    return rows.filter(F.col("expires_at") > event_time(as_of))


def write_view(rows: DataFrame, path: str, partition_by: list[str] | None = None, whole: bool = False) -> None:
    """Store a recomputed view.  With ``partition_by`` only the partitions the
    rows belong to are replaced, or with ``whole`` all there are, so none stays
    that the view no longer has; the rebalance hint keeps every task from writing
    a file into every partition and splits partitions that are large."""
    if not partition_by:
        rows.write.mode("overwrite").parquet(path)
        return
    packed = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = packed.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
