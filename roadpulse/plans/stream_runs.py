"""Runs of the streaming operators over the whole ``events`` table.

A stream keeps its last windows open until the watermark passes them.  To get
whole results these runs send one heartbeat row with a later time after the
data, as the next event of a live fleet would do; it closes the windows and
stays behind in one that is never emitted.  The second half of each run
restarts the query from its checkpoint.  ``live_job`` does so with the whole job
and its own sinks, from messages to views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import textops
from roadpulse.schemas import TOPIC_RECORD
from roadpulse.session import state_partitions, whole_snapshots, workspace
from roadpulse.sources import codec, topic
from roadpulse.sources.testdata import vehicle_event_stream, vehicle_events
from roadpulse.streaming import pipeline
from roadpulse.streaming.live import first_sightings_stream, running_totals_stream
from roadpulse.streaming.text_stream import run_text_stream

# Far enough to pass any watermark, window and idle time.
HEARTBEAT_AHEAD = "INTERVAL 7 DAYS"
HEARTBEAT, BEAT_PARTITION = "heartbeat", 4
# Processing time of the views, so that results can be checked.
AS_OF = "2024-02-01 00:00:00"
# Events that reach the job last, whenever they happened.
DELAYED = "event_id % 10 = 3"


def _heartbeat(events: DataFrame) -> DataFrame:
    """One row after the last event, null but for its time."""
    last = events.agg((F.max("ts") + F.expr(HEARTBEAT_AHEAD)).alias("ts"))
    return last.select(
        *[
            F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in events.schema.fields
        ]
    )


def run_to_end(
    spark: SparkSession,
    stream: DataFrame,
    events: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    root: str,
) -> DataFrame:
    """Run ``build`` over the stream, then over the heartbeat; the rows written.

    ``events`` is the same data as a batch, for the schema and the last time."""
    beats = f"{root}/heartbeat"
    events.limit(0).write.parquet(beats)
    watched = spark.readStream.schema(events.schema).parquet(beats)
    with state_partitions(spark):
        rows = build(stream.select(events.columns).unionByName(watched))

    def run() -> None:
        writer = rows.writeStream.format("parquet").option("path", f"{root}/rows")
        writer = writer.option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
        with state_partitions(spark), whole_snapshots(spark):
            query = writer.trigger(availableNow=True).start()
        query.awaitTermination()

    run()
    _heartbeat(events).write.mode("append").parquet(beats)
    run()
    return spark.read.schema(rows.schema).parquet(f"{root}/rows")


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = vehicle_events(spark, sf_dir)
    stream = vehicle_event_stream(spark, sf_dir)
    return run_to_end(
        spark, stream, events, first_sightings_stream, workspace(spark, "stream-sightings")
    )


def _sightings_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sightings as a table a later stage reads: as a stream and as a batch."""
    events = vehicle_events(spark, sf_dir)
    root = workspace(spark, "stream-sightings")
    rows = run_to_end(
        spark, vehicle_event_stream(spark, sf_dir), events, first_sightings_stream, root
    )
    return spark.readStream.schema(rows.schema).parquet(f"{root}/rows"), rows


def total_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, rows = _sightings_stream(spark, sf_dir)
    return run_to_end(
        spark, stream, rows, running_totals_stream, workspace(spark, "stream-totals")
    )


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as topic records: four partitions, offsets counted up."""
    return _as_records(vehicle_events(spark, sf_dir))


def _as_records(events: DataFrame, partition: Column | None = None) -> DataFrame:
    place = F.col("event_id") % 4 if partition is None else partition
    return topic.as_topic_records(codec.encode(events), place, F.floor(F.col("event_id") / 4))


def _beats(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Two messages long after the last event.  The first closes the buckets of
    the data; the second closes the first one's, whose sighting does the same for
    the views of sightings.  They have a route of their own and are nowhere near
    the point of interest."""
    last = events.agg(F.max("ts").alias("last"), F.max("event_id").alias("id"))
    beat = last.select("last", "id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    values = {
        "event_id": F.col("id") + F.col("k"),
        "vehicle_id": F.concat(F.lit(HEARTBEAT), F.col("k").cast("string")),
        "vehicle_type": F.lit("Bus"),
        "route_id": F.lit(HEARTBEAT),
        "latitude": F.lit(0.0),
        "longitude": F.lit(0.0),
        "ts": F.col("last") + F.col("k") * F.expr(HEARTBEAT_AHEAD),
        "speed": F.lit(0.0),
        "fuel_level": F.lit(0.0),
    }
    return beat.select(*[values[c].alias(c) for c in events.columns])


# Finished runs by session, table folder and kind: several queries read one run.
_RUNS: dict[tuple, pipeline.LiveConfig] = {}


def live_job(spark: SparkSession, sf_dir: str, delayed: str | None = None) -> pipeline.LiveConfig:
    """The live job over the events sent as JSON, in rounds: the earlier half of
    the time, the later half, then the ``delayed`` events of both, then the
    heartbeats, which have a topic partition of their own.  Each round starts
    every stage anew from its checkpoint and runs it to the end of what is there.
    With delayed events only the stages up to the sightings run."""
    kind = (spark.sparkContext.applicationId, sf_dir, delayed)
    if kind in _RUNS:
        return _RUNS[kind]
    events = vehicle_events(spark, sf_dir)
    root = workspace(spark, "live-job")
    cfg = pipeline.LiveConfig(root, available_now=True, as_of=AS_OF)
    if delayed:
        cfg.stages = ["archive", "gate", "sightings"]
    span = events.agg(F.unix_micros(F.min("ts")).alias("low"), F.unix_micros(F.max("ts")).alias("high")).first()
    late, middle = F.expr(delayed or "false"), F.timestamp_micros(F.lit((span.low + span.high) // 2))
    first, second = (events.filter(~late & half) for half in (F.col("ts") < middle, F.col("ts") >= middle))
    rounds = [_as_records(rows) for rows in (first, second, *([events.filter(late)] if delayed else []))]
    for records in [*rounds, _as_records(_beats(spark, events), F.lit(BEAT_PARTITION))]:
        records.write.mode("append").parquet(f"{root}/topic")
        arriving = topic.topic_file_stream(spark, f"{root}/topic")
        pipeline.run_stream(spark, arriving.select([f.name for f in TOPIC_RECORD.fields]), cfg)
    _RUNS[kind] = cfg
    return cfg


def text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of the documents read as a stream of text files."""
    root = workspace(spark, "stream-text")
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("value"))
    textops.lines(texts).write.text(f"{root}/lines")
    lines = spark.readStream.format("text").load(f"{root}/lines")
    run_text_stream(spark, lines, f"{root}/out", available_now=True).awaitTermination()
    per_batch = spark.read.parquet(f"{root}/out/counts")
    return per_batch.groupBy("word").agg(F.sum("count").alias("count"))
