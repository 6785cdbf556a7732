"""Topic source and sink: options as plain dictionaries, records as DataFrames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import TOPIC_RECORD

# Fixed value: name of the topic vehicles send to.
TOPIC = "iot-data-event"
# Fixed value: the offset that stands for a partition's earliest record.
EARLIEST = -2


def topic_options(
    brokers: str,
    topic: str = TOPIC,
    saved_offsets: dict[str, dict[int, int]] | None = None,
    max_records: int | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.  The group is named after the topic, a
    first start reads from the earliest record, and ``saved_offsets`` (from
    ``operators.offsets``) starts from those instead, see ``start_of``.  Neither
    matters once the query has a checkpoint."""
    start = start_of(saved_offsets or {}, topic, partitions)
    options = {
        "kafka.bootstrap.servers": brokers,
        "kafka.group.id": topic,
        "subscribe": topic,
        "startingOffsets": starting_offsets_json(start) if start else "earliest",
        "failOnDataLoss": "true",
    }
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def start_of(
    saved: dict[str, dict[int, int]], topic: str = TOPIC, partitions: int | None = None
) -> dict[str, dict[int, int]]:
    """Start of every partition of one topic; empty if none of it is saved.

    The source refuses offsets that leave out a partition of the topic.
    ``partitions`` is their number; those without a saved offset start from
    their earliest record.  Without it only saved partitions are named, which
    holds if each of them has archived records.  Other topics are left out."""
    own = saved.get(topic)
    if not own:
        return {}
    return {topic: {p: own.get(p, EARLIEST) for p in {*own, *range(partitions or 0)}}}


def starting_offsets_json(offsets: dict[str, dict[int, int]]) -> str:
    """``{"topic": {"partition": next offset}}`` as the source expects it."""
    text = {t: {str(p): o for p, o in sorted(parts.items())} for t, parts in sorted(offsets.items())}
    return json.dumps(text, separators=(",", ":"))


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming topic scan; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**options)
    return reader.load().select([f.name for f in TOPIC_RECORD.fields])


def topic_file_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same records from Parquet files, as they arrive in a folder."""
    return spark.readStream.schema(TOPIC_RECORD).options(**options).parquet(path)


def write_topic(messages: DataFrame, brokers: str, topic: str = TOPIC) -> None:
    """Send encoded messages (``sources.codec.encode``) to a topic."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )


def as_topic_records(messages: DataFrame, partition, offset, topic: str = TOPIC) -> DataFrame:
    """Give encoded messages the columns of a topic scan."""
    return messages.select(
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
    )
