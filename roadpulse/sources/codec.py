"""JSON messages to typed events and back; bad messages become dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geo import on_globe
from roadpulse.functions.times import iso_weekday, parse_event_time
from roadpulse.schemas import ARCHIVE, CORRUPT_FIELD, MESSAGE

OK = "ok"
DEAD = "dead"


# An event may be this much later than its arrival at the topic; a clock further
# ahead would carry the watermark of the live views away.
MAX_AHEAD_SECONDS = 3600


def decode(
    records: DataFrame, source_tz: str | None = None, max_ahead_seconds: int = MAX_AHEAD_SECONDS
) -> DataFrame:
    """Topic records to archive rows (``schemas.ARCHIVE``).

    Good and bad messages travel in one DataFrame, told apart by ``status``, so
    a stream is read and parsed once.  ``error`` says why a row is dead.  A
    missing speed or fuel level counts as 0; a missing vehicle, route or type, a
    number that isn't finite, a place off the globe, and an event more than
    ``max_ahead_seconds`` later than its record's timestamp make a row dead.  No
    value ends the job.  Offsets are kept per record:
    ``[from_offset, until_offset)`` is the record's own range, so the minimum
    and maximum over any set of rows are the range of that set, however the
    input was cut into micro-batches.
    """
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_FIELD}
    # exploding an array of one keeps later filters above the parser; pushed
    # below, they would parse every message once per column they look at
    parsed = records.select(
        "topic",
        F.col("partition").alias("kafka_partition"),
        "offset",
        F.col("timestamp").alias("arrived"),
        text.alias("raw_value"),
        F.explode(F.array(F.from_json(text, MESSAGE, options))).alias("m"),
    )
    m = F.col("m")
    typed = parsed.select(
        "topic",
        "kafka_partition",
        "offset",
        "arrived",
        "raw_value",
        m["vehicleId"].alias("vehicle_id"),
        m["vehicleType"].alias("vehicle_type"),
        m["routeId"].alias("route_id"),
        m["latitude"].try_cast("double").alias("latitude"),
        m["longitude"].try_cast("double").alias("longitude"),
        parse_event_time(m["timestamp"], source_tz).alias("ts"),
        _number_or_zero(m["speed"]).alias("speed"),
        _number_or_zero(m["fuelLevel"]).alias("fuel_level"),
        (m.isNull() | m[CORRUPT_FIELD].isNotNull()).alias("unreadable"),
    )
    checked = typed.withColumn(
        "error",
        F.when(F.col("unreadable"), "bad_json")
        .when(F.col("vehicle_id").isNull() | F.col("vehicle_type").isNull() | F.col("route_id").isNull(), "bad_key")
        .when(F.col("ts").isNull(), "bad_timestamp")
        .when(F.col("ts") > F.col("arrived") + F.make_dt_interval(secs=F.lit(max_ahead_seconds)), "future_timestamp")
        .when(~on_globe(F.col("latitude"), F.col("longitude")), "bad_coordinate")
        .when(~(_finite("speed") & _finite("fuel_level")), "bad_number"),
    )
    dead = F.col("error").isNotNull()
    return checked.select(
        "vehicle_id",
        "vehicle_type",
        "route_id",
        "latitude",
        "longitude",
        "ts",
        "speed",
        "fuel_level",
        "offset",
        F.col("offset").alias("from_offset"),
        (F.col("offset") + 1).alias("until_offset"),
        F.when(dead, F.col("raw_value")).alias("raw_value"),
        "error",
        F.when(dead, DEAD).otherwise(OK).alias("status"),
        "topic",
        "kafka_partition",
        F.to_date("ts").alias("event_date"),
        iso_weekday(F.col("ts")).alias("day_of_week"),
    ).select([f.name for f in ARCHIVE.fields])


def _number_or_zero(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0.0)).otherwise(text.try_cast("double"))


def _finite(name: str) -> Column:
    """False for null, NaN and infinite numbers."""
    return F.coalesce(F.abs(name) < float("inf"), F.lit(False))


def good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == OK)


def dead_letters(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == DEAD).select(
        "topic", "kafka_partition", "offset", "raw_value", "error"
    )


def encode(events: DataFrame, time_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> DataFrame:
    """Events to JSON messages, keyed by vehicle; other columns stay."""
    message = F.struct(
        F.col("vehicle_id").alias("vehicleId"),
        F.col("vehicle_type").alias("vehicleType"),
        F.col("route_id").alias("routeId"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        F.date_format("ts", time_format).alias("timestamp"),
        F.col("speed").alias("speed"),
        F.col("fuel_level").alias("fuelLevel"),
    )
    return events.withColumns({"key": F.col("vehicle_id"), "value": F.to_json(message)})
