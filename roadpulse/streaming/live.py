"""The live views as streaming transformations, DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators.running import KEYS
from roadpulse.operators.sightings import IDLE_SECONDS, reduce_per_vehicle
from roadpulse.streaming.state import FirstSightings, RunningTotals

WATERMARK = "10 minutes"
# Fixed value: length of the live micro-batches, in seconds.
BATCH_SECONDS = 5
# Much longer than a vehicle's sending interval and short beside the watermark.
SIGHTING_SECONDS = 60
# Vehicles share this many states, by hash.  A checkpoint holds for its number.
VEHICLE_GROUPS = 2048
# Spark's own formats for times in JSON cut them to milliseconds.
_WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def first_sightings_stream(
    events: DataFrame,
    idle_seconds: int = IDLE_SECONDS,
    watermark: str = WATERMARK,
    every_seconds: int = SIGHTING_SECONDS,
    groups: int = VEHICLE_GROUPS,
) -> DataFrame:
    """Each vehicle's first event, and its next one after more than
    ``idle_seconds`` of silence.

    Events are reduced per vehicle and bucket inside Spark; the state only sees
    the earliest event and last time of each bucket.  Buckets arrive in event
    time order because they are emitted by the watermark, so the result does not
    depend on how the input was cut into files or batches.  Vehicles are dealt
    over ``groups`` states; a group's buckets of one batch are held together.  Buckets may have any
    length up to the idle time; it delays a sighting by as much.
    """
    if every_seconds > idle_seconds:
        raise ValueError("a bucket longer than the idle time hides silences")
    bucket = F.window("ts", f"{every_seconds} seconds")
    reduced = reduce_per_vehicle(events.withWatermark("ts", watermark), bucket)
    # the event travels through Python as one text, its times as numbers
    columns = events.schema.fields
    times = [f.name for f in columns if isinstance(f.dataType, T.TimestampType)]
    packed = [
        (F.unix_micros(f"first.{f.name}") if f.name in times else F.col(f"first.{f.name}")).alias(f.name)
        for f in columns
    ]
    flat = reduced.select(
        F.pmod(F.xxhash64("vehicle_id"), F.lit(groups)).alias("group"),
        F.coalesce(F.concat(F.lit("="), F.col("vehicle_id")), F.lit("")).alias("vehicle"),
        F.unix_micros("first.ts").alias("first_us"),
        F.unix_micros("last_ts").alias("last_us"),
        F.to_json(F.struct(*packed), _WHOLE_TIMES).alias("event"),
    )
    processor = FirstSightings(idle_seconds * 1_000_000, every_seconds * 1_000_000)
    sightings = flat.groupBy("group").transformWithStateInPandas(processor, "event string", "append", "EventTime")
    sent = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in columns])
    back = sightings.select(F.from_json("event", sent, _WHOLE_TIMES).alias("event"))
    return back.select(
        *[
            (F.timestamp_micros(f"event.{f.name}") if f.name in times else F.col(f"event.{f.name}")).alias(f.name)
            for f in columns
        ]
    )


def running_totals_stream(
    sightings: DataFrame,
    idle_seconds: int = IDLE_SECONDS,
    watermark: str = WATERMARK,
    every_seconds: int = BATCH_SECONDS,
) -> DataFrame:
    """Running count per route and type: ``route_id, vehicle_type, bucket, n,
    total_count``, one row per key and bucket.

    Spark counts each bucket first, so the few and busy keys reach the state as
    one row per bucket."""
    interval = F.window("ts", f"{every_seconds} seconds").alias("interval")
    counts = sightings.withWatermark("ts", watermark).groupBy(*KEYS, interval)
    flat = counts.agg(F.count("*").alias("n")).select(
        *KEYS, F.unix_micros("interval.start").alias("bucket_us"), "n"
    )
    out = "route_id string, vehicle_type string, bucket_us bigint, n bigint, total_count bigint"
    processor = RunningTotals(idle_seconds * 1_000_000, every_seconds * 1_000_000, KEYS)
    totals = flat.groupBy(*KEYS).transformWithStateInPandas(processor, out, "append", "EventTime")
    return totals.select(*KEYS, F.timestamp_micros("bucket_us").alias("bucket"), "n", "total_count")
