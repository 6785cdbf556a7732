"""The ``events`` table seen as vehicle events.

``VEHICLE_EVENTS_SQL`` is the one definition of the mapping; Spark and the
DuckDB oracle both evaluate it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS_DDL = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)

VEHICLE_COLUMNS = {
    "event_id": "event_id",
    "vehicle_id": "concat('V-', cast(user_id as varchar(20)))",
    "vehicle_type": (
        "case event_type when 'click' then 'Large Truck' when 'error' then 'Small Truck' "
        "when 'purchase' then 'Private Car' when 'view' then 'Bus' else 'Taxi' end"
    ),
    "route_id": (
        "case user_id % 3 when 0 then 'Route-37' when 1 then 'Route-43' else 'Route-82' end"
    ),
    "latitude": "52e0 + (user_id * 37 % 100) * 3 / 100e0 + (event_id % 5) / 10000e0",
    "longitude": "-(7e0 + (user_id % 60) * 5 / 100e0) + (event_id % 5) / 10000e0",
    "ts": "ts",
    "speed": "20e0 + value % 80",
    "fuel_level": "10e0 + event_id % 30",
}
VEHICLE_EVENTS_SQL = (
    "select " + ", ".join(f"{sql} as {name}" for name, sql in VEHICLE_COLUMNS.items()) + " from events"
)


def to_vehicle_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*[f"{sql} as {name}" for name, sql in VEHICLE_COLUMNS.items()])


def vehicle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declaring ``ts`` as an instant makes the reader convert it, so time
    filters still reach the Parquet scan."""
    return to_vehicle_events(spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet"))


def vehicle_event_stream(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    # a pattern, because a file stream takes folders or patterns but no file
    stream = spark.readStream.schema(EVENTS_DDL).options(**options)
    return to_vehicle_events(stream.parquet(f"{sf_dir}/events.parquet*"))
