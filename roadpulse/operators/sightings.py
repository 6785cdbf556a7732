"""De-duplication of vehicles: one event per vehicle until it falls silent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDLE_SECONDS = 3600
# Columns that settle the order of events with equal times, where present.
_TIE_BREAKERS = ("event_id", "topic", "kafka_partition", "offset")


def event_order(events: DataFrame) -> list[str]:
    return ["ts"] + [c for c in _TIE_BREAKERS if c in events.columns]


def bucket_of(ts: Column, seconds: int) -> Column:
    """Start of the time bucket, in epoch seconds; cheaper to group on than a
    window struct."""
    instant = F.unix_seconds(ts)
    return instant - F.pmod(instant, F.lit(seconds))


def reduce_per_vehicle(events: DataFrame, bucket: Column) -> DataFrame:
    """Earliest event and last time per vehicle and time bucket.

    Works on batch and streaming input.  The reduction runs before the shuffle
    as well as after it, so a vehicle that sends a third of all events costs one
    row per input task and bucket, not a third of the data in one task.  Map
    columns have no order and cannot be carried along.
    """
    order = event_order(events)
    rest = [c for c in events.columns if c not in order]
    return events.groupBy("vehicle_id", bucket.alias("bucket")).agg(
        F.min(F.struct(*order, *rest)).alias("first"), F.max("ts").alias("last_ts")
    )


def bucket_bounds(events: DataFrame, seconds: int) -> DataFrame:
    """``vehicle_id, bucket, first_us, last_us``: first and last time of each
    vehicle and bucket.  The aggregates are plain longs, so Spark hashes the
    events and sorts none of them."""
    micros = F.unix_micros("ts")
    return events.groupBy("vehicle_id", bucket_of(F.col("ts"), seconds).alias("bucket")).agg(
        F.min(micros).alias("first_us"), F.max(micros).alias("last_us")
    )


def events_at(events: DataFrame, places: DataFrame) -> DataFrame:
    """The event of each vehicle at each time of ``places`` (``vehicle_id,
    first_us``), of several the first in ``event_order``.  The join key holds the
    time, so a vehicle with much of the data is spread over the tasks; only
    events that are wanted are compared with each other."""
    wanted = places.select(F.col("vehicle_id").alias("__vehicle"), F.col("first_us").alias("__us"))
    same = F.col("vehicle_id").eqNullSafe(F.col("__vehicle")) & (F.unix_micros("ts") == F.col("__us"))
    order = event_order(events)
    rest = [c for c in events.columns if c not in (*order, "vehicle_id")]
    found = events.join(wanted, same, "left_semi").groupBy("vehicle_id", "ts")
    least = found.agg(F.min(F.struct(*order, *rest)).alias("first"))
    return least.select([F.col(c) if c in ("vehicle_id", "ts") else F.col(f"first.{c}") for c in events.columns])


def first_per_vehicle(events: DataFrame, every_seconds: int = 5) -> DataFrame:
    """One event per vehicle and batch interval, the earliest."""
    timed = events.filter(F.col("ts").isNotNull())
    return events_at(timed, bucket_bounds(timed, every_seconds))


def first_sightings(
    events: DataFrame, idle_seconds: int = IDLE_SECONDS, carry: list[str] | None = None
) -> DataFrame:
    """Events that follow more than ``idle_seconds`` of silence of their vehicle.

    ``carry`` names the columns wanted besides vehicle and order; the rest is
    not read, as an aggregated event cannot be pruned from outside.

    Two events in one bucket of ``idle_seconds`` are never that far apart, so
    only the earliest event of a bucket can qualify, and the event before it is
    the last one of the vehicle's previous bucket.  So times are reduced to one
    row per vehicle and bucket, the window that looks for gaps sees those rows
    only, and the events themselves are fetched for the times that qualify.
    """
    if carry is not None:
        wanted = {"vehicle_id", *event_order(events), *carry}
        events = events.select([c for c in events.columns if c in wanted])
    timed = events.filter(F.col("ts").isNotNull())
    w = Window.partitionBy("vehicle_id").orderBy("bucket")
    marked = bucket_bounds(timed, idle_seconds).withColumn("previous", F.lag("last_us").over(w))
    silent = F.col("previous").isNull() | (F.col("first_us") > F.col("previous") + idle_seconds * 1_000_000)
    return events_at(timed, marked.filter(silent))
