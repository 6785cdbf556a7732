"""How far each topic partition has been consumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadpulse.schemas import ARCHIVE
from roadpulse.sources.footers import archived_offsets
from roadpulse.sources.viewstore import read_if_exists


def latest_offsets(rows: DataFrame) -> DataFrame:
    """Next offset to read per topic partition.  Offsets compare as numbers even
    where a table stores them as text."""
    return rows.groupBy("topic", "kafka_partition").agg(
        F.max(F.col("until_offset").cast("bigint")).alias("until_offset")
    )


def saved_offsets(
    spark: SparkSession, path: str, schema: StructType | str = ARCHIVE
) -> dict[str, dict[int, int]]:
    """``{topic: {partition: next offset}}`` of an archive, empty if there is no
    archive yet.  One row per topic partition comes to the driver, and of an
    archive only file footers are read.

    With ``schema=schemas.LEDGER`` the path is the log of the job's ledger, which holds a
    row per batch instead of one per event."""
    rows = read_if_exists(spark, path, schema)
    if rows is None:
        return {}
    offsets: dict[str, dict[int, int]] = {}
    latest = archived_offsets(spark, path) if schema == ARCHIVE else latest_offsets(rows)
    for row in latest.collect():
        offsets.setdefault(row.topic, {})[row.kafka_partition] = row.until_offset
    return offsets
