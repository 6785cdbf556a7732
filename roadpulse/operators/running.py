"""Running totals per key with an idle reset, as a two-level scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators.sightings import IDLE_SECONDS, bucket_of

KEYS = ["route_id", "vehicle_type"]


def counts_per_interval(events: DataFrame, every_seconds: int = 5, keys: list[str] = KEYS) -> DataFrame:
    """Events per key and batch interval: ``keys, bucket, n``."""
    timed = events.filter(F.col("ts").isNotNull())
    bucket = bucket_of(F.col("ts"), every_seconds).alias("bucket")
    counts = timed.groupBy(*keys, bucket).agg(F.count("*").alias("n"))
    return counts.withColumn("bucket", F.timestamp_seconds("bucket"))


def running_totals(
    events: DataFrame,
    idle_seconds: int = IDLE_SECONDS,
    every_seconds: int = 5,
    reset: str = "idle",
    keys: list[str] = KEYS,
) -> DataFrame:
    """Total per key after each batch interval: ``keys, bucket, n, total_count``.

    A key that is silent for more than ``idle_seconds`` starts again from zero.
    With ``reset="daily"`` it also starts again each day.

    There are few keys and one of them may hold most events, so a plain window
    per key would sort that key's whole history in one task.  Instead every
    (key, day) is summed on its own, the day sums are carried forward over one
    row per key and day, and the carry is joined back.
    """
    if reset not in ("idle", "daily"):
        raise ValueError(f"unknown reset {reset!r}: expected 'idle' or 'daily'")
    gap = F.make_dt_interval(secs=F.lit(idle_seconds))
    # one struct for the key: structs compare equal where a field is null, so the
    # join below keeps events without a route or type
    counts = counts_per_interval(events, every_seconds, keys).select(
        F.struct(*keys).alias("key"), "bucket", "n"
    )
    chunked = counts.withColumn("day", F.to_date("bucket"))

    in_day = Window.partitionBy("key", "day").orderBy("bucket")
    running = in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # "floor" is the sum up to the last reset of the day; sums only grow, so
    # the largest floor so far is the latest one
    rows = (
        chunked.withColumn("previous", F.lag("bucket").over(in_day))
        .withColumn("day_sum", F.sum("n").over(running))
        .withColumn(
            "reset_floor",
            F.when(F.col("bucket") > F.col("previous") + gap, F.col("day_sum") - F.col("n")),
        )
        .withColumn("floor", F.max("reset_floor").over(running))
    )
    if reset == "daily":
        total = F.col("day_sum") - F.coalesce("floor", F.lit(0))
        return _totals(rows, total)

    days = rows.groupBy("key", "day").agg(
        F.min("bucket").alias("first_bucket"),
        F.max("bucket").alias("last_bucket"),
        F.sum("n").alias("day_total"),
        F.max("floor").alias("day_floor"),
    )
    over_days = Window.partitionBy("key").orderBy("day")
    days_so_far = over_days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = (
        days.withColumn("sum_before", F.sum("day_total").over(days_so_far) - F.col("day_total"))
        .withColumn("last_before", F.lag("last_bucket").over(over_days))
        .withColumn(
            "starts_anew",
            F.col("last_before").isNull() | (F.col("first_bucket") > F.col("last_before") + gap),
        )
        .withColumn(
            "opening_floor", F.when(F.col("starts_anew"), F.col("sum_before"))
        )
        .withColumn(
            "key_floor",
            F.max(F.greatest("opening_floor", F.col("sum_before") + F.col("day_floor"))).over(
                days_so_far
            ),
        )
        .withColumn("floor_before", F.lag("key_floor").over(over_days))
        .withColumn(
            "carry",
            F.when(F.col("starts_anew"), F.lit(0)).otherwise(
                F.col("sum_before") - F.col("floor_before")
            ),
        )
        .select("key", "day", "carry")
    )
    total = F.when(F.col("floor").isNull(), F.col("carry") + F.col("day_sum")).otherwise(
        F.col("day_sum") - F.col("floor")
    )
    # every row finds its day; as a left join it puts no filter on the rows, so
    # both branches read the same shuffle instead of scanning the events twice
    return _totals(rows.join(carried, ["key", "day"], "left"), total)


def _totals(rows: DataFrame, total: Column) -> DataFrame:
    return rows.select("key.*", "bucket", "n", total.alias("total_count"))
