"""The event archive: Parquet partitioned by status, topic, topic partition,
day and weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import ARCHIVE, ARCHIVE_PARTITIONS

BROADCAST_RANGES = 10_000


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan.  Filters on the partition columns skip whole folders."""
    return spark.read.schema(ARCHIVE).parquet(path)


def archive_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Rows as the archiving query commits them."""
    return spark.readStream.schema(ARCHIVE).options(**options).parquet(path)


def write_archive(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Batch write.  The rebalance hint lets AQE split a folder that holds much
    of the data over many tasks and pack small folders into one file each."""
    (
        rows.hint("rebalance", *[F.col(c) for c in ARCHIVE_PARTITIONS])
        .write.mode(mode)
        .partitionBy(*ARCHIVE_PARTITIONS)
        .parquet(path)
    )


def offset_range(rows: DataFrame) -> DataFrame:
    """Consumed ``[from, until)`` per topic partition, one row each."""
    return rows.groupBy("topic", "kafka_partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")
    )


def attach_offset_range(rows: DataFrame, broadcast_rows: int = BROADCAST_RANGES) -> DataFrame:
    """Stamp every row of a batch with the batch's range per topic partition.

    The ranges are one row per topic partition.  Up to ``broadcast_rows`` of
    them go through the driver into a broadcast, so the events, of which one
    partition may hold much, are not shuffled; more than that are joined by a
    shuffle."""
    ranges = offset_range(rows)
    found = ranges.limit(broadcast_rows + 1).collect()
    if len(found) <= broadcast_rows:
        ranges = F.broadcast(rows.sparkSession.createDataFrame(found, ranges.schema))
    return rows.drop("from_offset", "until_offset").join(ranges, ["topic", "kafka_partition"])


def meta_map(rows: DataFrame) -> DataFrame:
    """Put the origin of each row into one map column of texts."""
    names = {
        "topic": "topic",
        "fromOffset": "from_offset",
        "kafkaPartition": "kafka_partition",
        "untilOffset": "until_offset",
        "dayOfWeek": "day_of_week",
    }
    entries = [x for key, c in names.items() for x in (F.lit(key), F.col(c).cast("string"))]
    return rows.withColumn("meta", F.create_map(*entries)).drop(*names.values())


def flatten_meta(rows: DataFrame) -> DataFrame:
    """Map entries back to typed columns."""
    meta = F.col("meta")
    return rows.withColumns(
        {
            "topic": meta["topic"],
            "kafka_partition": meta["kafkaPartition"].cast("int"),
            "from_offset": meta["fromOffset"].cast("bigint"),
            "until_offset": meta["untilOffset"].cast("bigint"),
            "day_of_week": meta["dayOfWeek"].cast("int"),
        }
    ).drop("meta")
