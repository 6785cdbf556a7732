"""What file footers alone can answer: counts, least and greatest numbers per
partition folder, without a row being read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.traffic import event_time_span
from roadpulse.schemas import ARCHIVE, ARCHIVE_PARTITIONS
from roadpulse.sources.archive import read_archive
from roadpulse.sources.codec import good

_V1_SOURCES = "spark.sql.sources.useV1SourceList"
_PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def footers_only(spark: SparkSession) -> Iterator[None]:
    """Parquet scans made *and run* inside push aggregates into the scan.  The
    settings are the session's, so they are put back afterwards."""
    before = {key: spark.conf.get(key) for key in (_V1_SOURCES, _PUSH_DOWN)}
    spark.conf.set(_V1_SOURCES, ",".join(s for s in before[_V1_SOURCES].split(",") if s != "parquet"))
    spark.conf.set(_PUSH_DOWN, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def folder_aggregates(spark: SparkSession, path: str, *aggregates: Column) -> DataFrame:
    """One row per folder of the archive.  Only aggregates grouped by all the
    partition columns are pushed; what is wanted of fewer columns is aggregated
    once more from these rows.  To be used inside ``footers_only``."""
    return spark.read.schema(ARCHIVE).parquet(path).groupBy(*ARCHIVE_PARTITIONS).agg(*aggregates)


def archived_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Next offset per topic partition of the archive, as
    ``operators.offsets.latest_offsets`` finds it from the rows.  The few rows
    go through the driver, since the settings hold while the scan runs."""
    with footers_only(spark):
        folders = folder_aggregates(spark, path, F.max("until_offset").alias("until_offset"))
        latest = folders.groupBy("topic", "kafka_partition").agg(F.max("until_offset").alias("until_offset"))
        rows = latest.collect()
    return spark.createDataFrame(rows, latest.schema)


def archived_span(spark: SparkSession, path: str) -> DataFrame:
    """``event_time_span`` of the archive's good rows.  Footers give the first and
    the last day (time stamps have no usable statistics), and only the folders
    of these two days are read."""
    with footers_only(spark):
        days = good(folder_aggregates(spark, path, F.count(F.lit(1)).alias("n"))).filter("n > 0")
        first, last = days.agg(F.min("event_date"), F.max("event_date")).first()
    rows = good(read_archive(spark, path))
    return event_time_span(rows.filter(F.col("event_date").isin([first, last]) if first else F.lit(False)))
