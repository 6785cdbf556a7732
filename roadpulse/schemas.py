"""Record types.  Every scan declares its schema; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns every operator expects of a vehicle event.
VEHICLE_EVENT = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("fuel_level", T.DoubleType()),
    ]
)

# What a Kafka scan delivers, also used for Parquet copies of a topic.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# The JSON message.  Every field is read as text, so that a number sent as a
# string and a string sent as a number both decode, and then cast.
MESSAGE_FIELDS = (
    "vehicleId",
    "vehicleType",
    "routeId",
    "latitude",
    "longitude",
    "timestamp",
    "speed",
    "fuelLevel",
)
CORRUPT_FIELD = "_corrupt_record"
MESSAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in MESSAGE_FIELDS]
    + [T.StructField(CORRUPT_FIELD, T.StringType())]
)

# Archived events: the event, where it came from, and the dead-letter fields.
# The last five columns are the partition directories.
ARCHIVE_PARTITIONS = ["status", "topic", "kafka_partition", "event_date", "day_of_week"]
ARCHIVE = T.StructType(
    VEHICLE_EVENT.fields
    + [
        T.StructField("offset", T.LongType()),
        T.StructField("from_offset", T.LongType()),
        T.StructField("until_offset", T.LongType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("day_of_week", T.IntegerType()),
    ]
)

# Consumed offsets per batch and topic partition.
LEDGER = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("from_offset", T.LongType()),
        T.StructField("until_offset", T.LongType()),
    ]
)

POI = T.StructType(
    [
        T.StructField("poi_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("radius_km", T.DoubleType()),
        T.StructField("vehicle", T.StringType()),
        T.StructField("route", T.StringType()),
    ]
)

# Column order of a delimited event row.
DELIMITED_EVENT = T.StructType(
    [
        T.StructField("ts", T.DateType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("fuel_level", T.DoubleType()),
    ]
)

TRAFFIC_VIEW = T.StructType(
    [
        T.StructField("route_id", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("total_count", T.LongType()),
        T.StructField("time_stamp", T.TimestampType()),
        T.StructField("record_date", T.StringType()),
    ]
)
POI_VIEW = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("distance", T.LongType()),
        T.StructField("time_stamp", T.TimestampType()),
    ]
)
HEAT_MAP_VIEW = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("total_count", T.LongType()),
        T.StructField("time_stamp", T.TimestampType()),
    ]
)

# Primary keys of the keyed views.  Window views add the window start.
VIEW_KEYS = {
    "total_traffic": ["route_id", "record_date", "vehicle_type"],
    "window_traffic": ["route_id", "record_date", "vehicle_type", "window_start"],
    "poi_traffic": ["vehicle_id"],
    "heat_map": ["latitude", "longitude", "window_start"],
}

# The routes and vehicle types of the message generator, in the
# order the traffic chart shows them.
ROUTES = ["Route-37", "Route-82", "Route-43"]
VEHICLE_TYPES = ["Bus", "Large Truck", "Private Car", "Small Truck", "Taxi"]


