"""The registered queries: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.times import in_interval, record_date
from roadpulse.operators import (
    heatmap,
    offsets,
    poi,
    running,
    serving,
    sightings,
    speed,
    textops,
    traffic,
)
from roadpulse.operators.windows import newest_window
from roadpulse.plans import stream_runs
from roadpulse.plans.jobs import BatchConfig, publish_changes, published, run_batch
from roadpulse.schemas import VEHICLE_EVENT, VIEW_KEYS
from roadpulse.session import prepare, workspace
from roadpulse.sources import archive, codec, compaction, delimited, footers, topic, viewstore
from roadpulse.sources.testdata import vehicle_events
from roadpulse.streaming import pipeline, progress

Query = Callable[[SparkSession, str], DataFrame]

# Processing time and slices the queries use, so that results can be checked.
AS_OF = stream_runs.AS_OF
INTERVAL = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
DAY = "2024-01-15"
VIEW_TIME = "2024-01-15 12:00:00"
VIEW_TTL_SECONDS = 86_400
LONG_VISIT_SECONDS = 21_600
TOPIC_PARTITIONS = 6
LIGHT_PENALTY = 0.001

TEST_POI = poi.PointOfInterest(53.877495, -6.50238, 100.0, "Truck", "Route-37", "test_filtered")
POINTS = [
    poi.LIVE_POI,
    poi.BATCH_POI,
    TEST_POI,
    poi.PointOfInterest(53.3, -8.0, 5.0, None, None, "small"),
    poi.PointOfInterest(54.0, -9.0, 40.0, "Car", None, "cars"),
    poi.PointOfInterest(52.5, -7.5, 2000.0, None, "Route-82", "wide"),
    poi.PointOfInterest(89.0, 10.0, 4200.0, "Bus", None, "polar"),
]

_REGISTRY: dict[str, Query] = {}


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return _plain_times(build(spark, sf_dir))

    run.__doc__ = build.__doc__
    _REGISTRY[build.__name__] = run
    return build


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _plain_times(rows: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, which compare in any session."""
    return rows.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in rows.schema.fields
        ]
    )


# --- batch views -----------------------------------------------------------


@_query
def total_traffic_batch(spark, sf_dir):
    return traffic.total_traffic(vehicle_events(spark, sf_dir), AS_OF)


@_query
def daily_traffic(spark, sf_dir):
    return traffic.daily_traffic(vehicle_events(spark, sf_dir), AS_OF)


@_query
def daily_traffic_complete_days(spark, sf_dir):
    return traffic.daily_traffic(vehicle_events(spark, sf_dir), AS_OF, include_last_day=False)


@_query
def total_of_daily_traffic(spark, sf_dir):
    return traffic.total_of_daily(traffic.daily_traffic(vehicle_events(spark, sf_dir), AS_OF), AS_OF)


@_query
def event_time_span(spark, sf_dir):
    return traffic.event_time_span(vehicle_events(spark, sf_dir))


def _interval(events: DataFrame) -> tuple:
    """``INTERVAL`` from its first event on, so that one lies on the bound."""
    first = events.filter(F.col("ts") >= F.lit(INTERVAL[0]).cast("timestamp")).agg(F.min("ts")).first()[0]
    return first, INTERVAL[1]


@_query
def events_in_interval(spark, sf_dir):
    events = vehicle_events(spark, sf_dir)
    kept = events.filter(in_interval(F.col("ts"), *_interval(events)))
    return kept.select("event_id", "vehicle_id", "ts")


@_query
def events_in_open_interval(spark, sf_dir):
    events = vehicle_events(spark, sf_dir)
    kept = events.filter(in_interval(F.col("ts"), *_interval(events), bounds="open"))
    return kept.select("event_id", "vehicle_id", "ts")


@_query
def window_traffic_30s_10s(spark, sf_dir):
    return traffic.window_traffic(vehicle_events(spark, sf_dir), AS_OF)


@_query
def window_traffic_of_sightings(spark, sf_dir):
    events = sightings.first_sightings(vehicle_events(spark, sf_dir), carry=running.KEYS)
    return traffic.window_traffic(events, AS_OF)


@_query
def measurements(spark, sf_dir):
    return heatmap.measurements(vehicle_events(spark, sf_dir))


@_query
def heatmap_daily(spark, sf_dir):
    return heatmap.heatmap_daily(vehicle_events(spark, sf_dir))


@_query
def heatmap_daily_open(spark, sf_dir):
    return heatmap.heatmap_daily(vehicle_events(spark, sf_dir), bounds="open", include_last_day=False)


@_query
def heatmap_degree(spark, sf_dir):
    return heatmap.heatmap_daily(vehicle_events(spark, sf_dir), grid="degree")


@_query
def heatmap_120s_10s(spark, sf_dir):
    return heatmap.heatmap_window(vehicle_events(spark, sf_dir), as_of=AS_OF)


@_query
def heatmap_of_sightings_degree(spark, sf_dir):
    events = sightings.first_sightings(vehicle_events(spark, sf_dir), carry=["latitude", "longitude"])
    return heatmap.heatmap_window(events, grid="degree", as_of=AS_OF)


# --- points of interest ----------------------------------------------------


def _near(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        "event_id",
        "vehicle_id",
        "vehicle_type",
        *extra,
        F.round("distance_km", 6).alias("distance_km"),
        F.col("distance_km").cast("bigint").alias("distance"),
    )


@_query
def poi_vehicles_live(spark, sf_dir):
    return _near(poi.near_point(vehicle_events(spark, sf_dir), poi.LIVE_POI))


@_query
def poi_vehicles_batch(spark, sf_dir):
    return _near(poi.near_point(vehicle_events(spark, sf_dir), poi.BATCH_POI))


@_query
def poi_vehicles_route_truck(spark, sf_dir):
    return _near(poi.near_point(vehicle_events(spark, sf_dir), TEST_POI))


@_query
def poi_multi_join(spark, sf_dir):
    points = poi.poi_table(spark, POINTS)
    return _near(poi.near_points(vehicle_events(spark, sf_dir), points), "poi_id")


@_query
def poi_multi_join_salted(spark, sf_dir):
    """The join for point tables too large to broadcast."""
    points = poi.poi_table(spark, POINTS)
    joined = poi.near_points(vehicle_events(spark, sf_dir), points, broadcast_points=0, parts=8)
    return _near(joined, "poi_id")


@_query
def poi_latest_per_vehicle(spark, sf_dir):
    rows = poi.latest_per_vehicle(poi.near_point(vehicle_events(spark, sf_dir), poi.LIVE_POI))
    return rows.withColumn("distance_km", F.round("distance_km", 6))


# --- de-duplication and running totals -------------------------------------


@_query
def first_sightings(spark, sf_dir):
    return sightings.first_sightings(vehicle_events(spark, sf_dir))


@_query
def first_per_vehicle_batch(spark, sf_dir):
    return sightings.first_per_vehicle(vehicle_events(spark, sf_dir))


@_query
def first_per_vehicle_day(spark, sf_dir):
    """The same per day, of which several events of a vehicle share one."""
    return sightings.first_per_vehicle(vehicle_events(spark, sf_dir), 86_400)


@_query
def total_traffic_running(spark, sf_dir):
    events = sightings.first_sightings(vehicle_events(spark, sf_dir), carry=running.KEYS)
    return running.running_totals(events)


@_query
def total_traffic_running_all_events(spark, sf_dir):
    return running.running_totals(vehicle_events(spark, sf_dir))


@_query
def total_traffic_running_daily(spark, sf_dir):
    return running.running_totals(vehicle_events(spark, sf_dir), reset="daily")


@_query
def counts_per_batch(spark, sf_dir):
    return running.counts_per_interval(vehicle_events(spark, sf_dir))


# --- messages, archive, offsets --------------------------------------------


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode(stream_runs.topic_records(spark, sf_dir))


@_query
def json_messages(spark, sf_dir):
    messages = codec.encode(vehicle_events(spark, sf_dir))
    field = F.get_json_object
    return messages.select(
        "event_id",
        "key",
        field("value", "$.routeId").alias("route_id"),
        field("value", "$.timestamp").alias("timestamp"),
        field("value", "$.latitude").cast("double").alias("latitude"),
        field("value", "$.speed").cast("double").alias("speed"),
    )


@_query
def json_roundtrip(spark, sf_dir):
    rows = codec.good(_decoded(spark, sf_dir))
    return rows.select(
        "vehicle_id", "vehicle_type", "route_id", "latitude", "longitude", "ts", "speed",
        "fuel_level", "kafka_partition", "from_offset", "until_offset",
    )


def _with_faults(records: DataFrame) -> DataFrame:
    """Damage messages as if all small trucks and taxis, and buses on two routes,
    had faulty senders."""
    text = F.col("value").cast("string")
    kind = F.get_json_object(text, "$.vehicleType")
    route = F.get_json_object(text, "$.routeId")
    truck = kind == "Small Truck"
    damaged = (
        F.when(truck & (route == "Route-37"), F.lit("{bad"))
        .when(truck & (route == "Route-43"), F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .when(truck, F.regexp_replace(text, '"latitude":"[^"]*"', '"latitude":"north"'))
        .when(
            (kind == "Taxi") & (route == "Route-37"),
            F.regexp_replace(text, '"speed":[0-9.]+', '"speed":"fast"'),
        )
        .when(
            (kind == "Taxi") & (route == "Route-43"),
            F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"99999999999999999"'),
        )
        .when(kind == "Taxi", F.regexp_replace(text, '"longitude":"[^"]*"', '"longitude":"Infinity"'))
        .when((kind == "Bus") & (route == "Route-37"), F.regexp_replace(text, '"vehicleId":"[^"]*",', ""))
        .when(
            (kind == "Bus") & (route == "Route-43"),
            F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"2099-01-01 00:00:00"'),
        )
        .otherwise(text)
    )
    return records.withColumn("value", damaged.cast("binary"))


@_query
def dead_letter_split(spark, sf_dir):
    rows = codec.decode(_with_faults(stream_runs.topic_records(spark, sf_dir)))
    return codec.dead_letters(rows).drop("raw_value")


@_query
def good_after_faults(spark, sf_dir):
    rows = codec.good(codec.decode(_with_faults(stream_runs.topic_records(spark, sf_dir))))
    return traffic.total_traffic(rows, AS_OF)


@_query
def weekday_flatten(spark, sf_dir):
    """Origin of each row packed into a map and flattened again."""
    rows = archive.attach_offset_range(_decoded(spark, sf_dir))
    flat = archive.flatten_meta(archive.meta_map(rows))
    return flat.select(
        "vehicle_id", "offset", "topic", "kafka_partition", "from_offset", "until_offset", "day_of_week"
    )


def _written_archive(spark: SparkSession, sf_dir: str) -> str:
    path = workspace(spark, "archive")
    archive.write_archive(_decoded(spark, sf_dir), path)
    return path


@_query
def archive_roundtrip(spark, sf_dir):
    rows = archive.read_archive(spark, _written_archive(spark, sf_dir))
    return rows.select(
        "vehicle_id", "vehicle_type", "route_id", "latitude", "longitude", "ts", "speed",
        "fuel_level", "topic", "kafka_partition", "event_date", "day_of_week",
    )


@_query
def archive_pruned_scan(spark, sf_dir):
    rows = archive.read_archive(spark, _written_archive(spark, sf_dir))
    return (
        codec.good(rows)
        .filter(F.col("day_of_week") == 3)
        .groupBy("kafka_partition", "event_date")
        .agg(F.count("*").alias("n"), F.avg("speed").alias("avg_speed"))
        .withColumn("avg_speed", F.round("avg_speed", 6))
    )


def _archive_in_batches(spark: SparkSession, sf_dir: str, batches: int = 2) -> str:
    """An archive as a stream leaves it: files of every batch in every folder."""
    path = workspace(spark, "archive")
    rows = _decoded(spark, sf_dir)
    for batch in range(batches):
        archive.write_archive(rows.filter(F.pmod(F.col("offset"), F.lit(batches)) == batch), path)
    return path


@_query
def archive_compacted(spark, sf_dir):
    """Days before ``DAY`` compacted, then one topic partition's rows of a day
    once more as late ones: that folder is read from the archive again."""
    path, packed = _archive_in_batches(spark, sf_dir), workspace(spark, "compacted")
    compaction.compact(spark, path, packed, DAY)
    late = _decoded(spark, sf_dir).filter(F.to_date("ts") == F.date_sub(F.lit(DAY).cast("date"), 1))
    archive.write_archive(late.filter("kafka_partition = 1"), path)
    rows = compaction.read_compacted(spark, path, packed)
    files = rows.withColumn("file", F.input_file_name()).groupBy("kafka_partition", "event_date")
    # a compacted folder is one file at this size, one of the archive has several
    counts = files.agg(F.count("*").alias("n"), F.countDistinct("file").alias("files"))
    closed = F.col("event_date") < F.lit(DAY).cast("date")
    again = (F.col("event_date") == F.date_sub(F.lit(DAY).cast("date"), 1)) & (F.col("kafka_partition") == 1)
    return counts.select(
        "kafka_partition", "event_date", "n", F.when(closed & ~again, F.col("files")).alias("files")
    )


@_query
def archive_time_span(spark, sf_dir):
    """First and last event time of an archive from footers and two days."""
    return footers.archived_span(spark, _written_archive(spark, sf_dir))


@_query
def archived_offsets(spark, sf_dir):
    """Next offsets of an archive from file footers alone."""
    return footers.archived_offsets(spark, _archive_in_batches(spark, sf_dir))


@_query
def latest_offsets(spark, sf_dir):
    return offsets.latest_offsets(_decoded(spark, sf_dir))


@_query
def starting_offsets(spark, sf_dir):
    """Start position of a new streaming query, recovered from an archive of two
    topics; two partitions of the subscribed one have no records yet."""
    path = workspace(spark, "archive")
    rows = _decoded(spark, sf_dir)
    archive.write_archive(rows.unionByName(rows.withColumn("topic", F.lit("another-topic"))), path)
    start = topic.start_of(offsets.saved_offsets(spark, path), partitions=TOPIC_PARTITIONS)
    return spark.createDataFrame([(topic.starting_offsets_json(start),)], "offsets string")


@_query
def delimited_rows(spark, sf_dir):
    path = workspace(spark, "delimited")
    delimited.write_delimited(vehicle_events(spark, sf_dir), path)
    return delimited.read_delimited(spark, path)


# --- views and serving -----------------------------------------------------


def _total_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state the totals went through, one batch number per day."""
    totals = running.running_totals(vehicle_events(spark, sf_dir))
    return totals.select(
        "route_id",
        "vehicle_type",
        "total_count",
        F.col("bucket").alias("time_stamp"),
        record_date(F.col("bucket")).alias("record_date"),
        F.datediff("bucket", F.lit("1970-01-01").cast("date")).alias("batch_id"),
    )


def _total_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "view")
    _total_changes(spark, sf_dir).write.partitionBy("batch_id").parquet(f"{path}/log")
    return viewstore.read_view(spark, path, VIEW_KEYS["total_traffic"])


@_query
def view_latest_per_key(spark, sf_dir):
    return _total_view(spark, sf_dir)


@_query
def view_latest_ranked(spark, sf_dir):
    changes = _total_changes(spark, sf_dir)
    order = ["batch_id", "time_stamp"]
    return viewstore.latest_per_key_ranked(changes, VIEW_KEYS["total_traffic"], order).drop("batch_id")


@_query
def view_compacted(spark, sf_dir):
    """The current rows of a view's change log as a table of their own."""
    return _stored(spark, _total_view(spark, sf_dir), workspace(spark, "view-rows"))


@_query
def view_by_date(spark, sf_dir):
    return serving.by_date(_total_view(spark, sf_dir), DAY)


@_query
def window_view_by_date(spark, sf_dir):
    view = traffic.window_traffic(vehicle_events(spark, sf_dir), AS_OF)
    return serving.by_date(view, DAY)


def _stored(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """A view as readers find it: written once, then scanned."""
    viewstore.write_view(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@_query
def window_view_newest(spark, sf_dir):
    view = traffic.window_traffic(vehicle_events(spark, sf_dir), AS_OF)
    return newest_window(_stored(spark, view, workspace(spark, "window-view")))


@_query
def heatmap_at_time(spark, sf_dir):
    return serving.at_time(heatmap.heatmap_daily(vehicle_events(spark, sf_dir)), DAY)


@_query
def heatmap_points(spark, sf_dir):
    return serving.heatmap_points(heatmap.heatmap_daily(vehicle_events(spark, sf_dir)))


@_query
def poi_ttl_view(spark, sf_dir):
    """The point-of-interest view as it stood at one instant."""
    near = poi.near_point(vehicle_events(spark, sf_dir), poi.LIVE_POI)
    written = near.filter(F.col("ts") <= F.lit(VIEW_TIME).cast("timestamp"))
    rows = viewstore.with_expiry(poi.latest_per_vehicle(written), VIEW_TTL_SECONDS)
    kept = viewstore.unexpired(rows, VIEW_TIME)
    return kept.withColumn("distance_km", F.round("distance_km", 6))


@_query
def store_column_names(spark, sf_dir):
    return serving.store_names(traffic.total_traffic(vehicle_events(spark, sf_dir), AS_OF))


@_query
def traffic_pivot(spark, sf_dir):
    return serving.traffic_pivot(traffic.total_traffic(vehicle_events(spark, sf_dir), AS_OF))


@_query
def route37_slice(spark, sf_dir):
    return serving.route_slice(traffic.total_traffic(vehicle_events(spark, sf_dir), AS_OF))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of stored views: they are written first, as a dashboard reads
    them, so packing their rows does not recompute them."""
    events = vehicle_events(spark, sf_dir)
    root = workspace(spark, "views")

    nearby = poi.latest_per_vehicle(poi.near_point(events, poi.LIVE_POI))
    total = _stored(spark, _total_view(spark, sf_dir), f"{root}/total")
    window = _stored(spark, traffic.window_traffic(events, AS_OF), f"{root}/window")
    near = _stored(spark, nearby, f"{root}/poi")
    heat = _stored(spark, heatmap.heatmap_daily(events), f"{root}/heat")
    daily = serving.Tiling(
        "heatMap", ("latitude", "longitude", "time_stamp"), "date_format(time_stamp, 'yyyy-MM-dd')", serving.DEGREE_TILE
    )
    views = {
        "total_traffic": (serving.by_date(total, DAY), serving.TILINGS["total_traffic"]),
        "window_traffic": (serving.by_date(window, DAY), serving.TILINGS["window_traffic"]),
        "poi_traffic": (near, serving.TILINGS["poi_traffic"]),
        "heat_map": (heat, daily),
    }
    return serving.snapshot(views)


@_query
def snapshot_payload(spark, sf_dir):
    """Every document: view, date, tile and number of rows."""
    return _snapshot(spark, sf_dir).drop("payload")


_TRAFFIC_DDL = "route_id string, vehicle_type string, total_count bigint, time_stamp timestamp, record_date string"


@_query
def snapshot_total_rows(spark, sf_dir):
    return serving.unpack_snapshot(_snapshot(spark, sf_dir), "totalTraffic", _TRAFFIC_DDL)


@_query
def snapshot_window_rows(spark, sf_dir):
    schema = f"{_TRAFFIC_DDL}, window_start timestamp, window_end timestamp"
    return serving.unpack_snapshot(_snapshot(spark, sf_dir), "windowTraffic", schema)


@_query
def snapshot_poi_rows(spark, sf_dir):
    schema = "vehicle_id string, vehicle_type string, distance_km double, distance bigint, time_stamp timestamp"
    rows = serving.unpack_snapshot(_snapshot(spark, sf_dir), "poiTraffic", schema)
    return rows.withColumn("distance_km", F.round("distance_km", 6))


@_query
def snapshot_heatmap_rows(spark, sf_dir):
    """Heat-map rows back from the documents of the snapshot."""
    schema = "latitude double, longitude double, time_stamp timestamp, total_count bigint"
    return serving.unpack_snapshot(_snapshot(spark, sf_dir), "heatMap", schema)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the totals, published once before and once after the batch of
    the last day reached their change log."""
    root = workspace(spark, "published")
    cfg = pipeline.LiveConfig(root)
    log = f"{cfg.table('total_traffic')}/log"
    changes = _stored(spark, _total_changes(spark, sf_dir), f"{root}/changes")
    last = changes.agg(F.max("batch_id")).first()[0]
    for number, part in enumerate((F.col("batch_id") < last, F.col("batch_id") == last)):
        changes.filter(part).write.mode("append").partitionBy("batch_id").parquet(log)
        publish_changes(spark, cfg, f"{root}/documents", number)
    return published(spark, f"{root}/documents")


@_query
def snapshot_changed_tiles(spark, sf_dir):
    """What the second snapshot wrote: the tiles of the last day, no others."""
    return _published(spark, sf_dir).filter("snapshot = 1").select("view", "record_date", "tile", "rows")


@_query
def snapshot_current_rows(spark, sf_dir):
    """The whole view, back from the last document of every tile."""
    return serving.unpack_snapshot(serving.current_documents(_published(spark, sf_dir)), "totalTraffic", _TRAFFIC_DDL)


# --- streaming -------------------------------------------------------------


@_query
def stream_first_sightings(spark, sf_dir):
    return stream_runs.sightings(spark, sf_dir)


@_query
def stream_total_traffic(spark, sf_dir):
    return stream_runs.total_traffic(spark, sf_dir)


def _live(spark: SparkSession, sf_dir: str, view: str, **how) -> DataFrame:
    """A view of the live job after all its rounds, without the heartbeats."""
    rows = pipeline.live_view(spark, stream_runs.live_job(spark, sf_dir), view, **how)
    return rows.filter(F.col("route_id") != stream_runs.HEARTBEAT) if "route_id" in rows.columns else rows


@_query
def live_total_traffic(spark, sf_dir):
    """Running totals as the job stores them: the last bucket per key and day."""
    return _live(spark, sf_dir, "total_traffic")


@_query
def stream_window_traffic(spark, sf_dir):
    return _live(spark, sf_dir, "window_traffic", newest_only=False)


@_query
def stream_heatmap(spark, sf_dir):
    rows = _live(spark, sf_dir, "heat_map", newest_only=False)
    return rows.filter(F.col("latitude") != 0)


def _late_job(spark: SparkSession, sf_dir: str) -> pipeline.LiveConfig:
    return stream_runs.live_job(spark, sf_dir, stream_runs.DELAYED)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of the job with the event id their place in the topic stands for."""
    event_id = F.col("offset") * 4 + F.col("kafka_partition")
    known = rows.filter(F.col("route_id") != stream_runs.HEARTBEAT)
    return known.select(event_id.alias("event_id"), *[f.name for f in VEHICLE_EVENT.fields])


@_query
def stream_late_rows(spark, sf_dir):
    """Events that reach the job after their bucket was closed."""
    return _numbered(pipeline.late_rows(spark, _late_job(spark, sf_dir)))


@_query
def stream_sightings_on_time(spark, sf_dir):
    """First sightings among the events of the same run that were not late."""
    return _numbered(spark.read.parquet(_late_job(spark, sf_dir).table("sightings")))


@_query
def stream_poi(spark, sf_dir):
    """Every vehicle's last time near the point, before its row expires."""
    rows = _live(spark, sf_dir, "poi_traffic", as_of="1970-01-01")
    return rows.withColumn("distance_km", F.round("distance_km", 6))


@_query
def stream_poi_after_ttl(spark, sf_dir):
    """The view a minute after its last event: what came in the minute before
    that still shows, everything older has vanished after its 120 seconds."""
    cfg = stream_runs.live_job(spark, sf_dir)
    last = pipeline.live_view(spark, cfg, "poi_traffic", "1970-01-01").agg(F.max("time_stamp")).first()[0]
    rows = pipeline.live_view(spark, cfg, "poi_traffic", last + timedelta(seconds=60))
    return rows.withColumn("distance_km", F.round("distance_km", 6))


@_query
def poi_visits(spark, sf_dir):
    """When vehicles' rows appear near the point and vanish, in batch."""
    return poi.visits(poi.near_point(vehicle_events(spark, sf_dir), poi.LIVE_POI))


@_query
def poi_visits_long(spark, sf_dir):
    """The same with rows that last six hours, so that most visits have several events."""
    return poi.visits(poi.near_point(vehicle_events(spark, sf_dir), poi.LIVE_POI), LONG_VISIT_SECONDS)


@_query
def stream_poi_visits(spark, sf_dir):
    """Visits as the live job's state let them appear and vanish."""
    return pipeline.poi_visits(spark, stream_runs.live_job(spark, sf_dir))


@_query
def stream_progress(spark, sf_dir):
    """What the first stage read in all rounds and restarts, by its own reports."""
    cfg = stream_runs.live_job(spark, sf_dir)
    done = progress.progress_summary(progress.read_progress(spark, cfg.table("progress")))
    return done.filter(F.col("stage") == "archive")


@_query
def stream_archive(spark, sf_dir):
    cfg = stream_runs.live_job(spark, sf_dir)
    rows = codec.good(archive.read_archive(spark, cfg.table("archive"))).filter(F.col("route_id") != stream_runs.HEARTBEAT)
    return rows.select(
        "vehicle_id", "vehicle_type", "route_id", "latitude", "longitude", "ts", "speed",
        "fuel_level", "topic", "kafka_partition", "event_date", "day_of_week",
    )


@_query
def stream_ledger(spark, sf_dir):
    return _live(spark, sf_dir, "ledger").filter(F.col("kafka_partition") != stream_runs.BEAT_PARTITION)


@_query
def stream_word_count(spark, sf_dir):
    return stream_runs.text_counts(spark, sf_dir)


# --- batch job -------------------------------------------------------------


@_query
def batch_job_views(spark, sf_dir):
    """The whole batch job over an archive of JSON messages: rows and sum of
    every view it stores."""
    root = workspace(spark, "batch-job")
    cfg = BatchConfig(_written_archive(spark, sf_dir), root, TEST_POI, as_of=AS_OF)
    parts = []
    for name, path in sorted(run_batch(spark, cfg).items()):
        view = spark.read.parquet(path)
        amount = "distance" if name == "poi_traffic" else "total_count"
        parts.append(
            view.agg(F.count("*").alias("rows"), F.sum(amount).alias("amount")).select(
                F.lit(name).alias("view"), "rows", "amount"
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- speed model -----------------------------------------------------------


@_query
def speed_features(spark, sf_dir):
    return speed.speed_features(vehicle_events(spark, sf_dir))


@_query
def speed_split(spark, sf_dir):
    """Every event with the part it falls into."""
    training, test = speed.split(speed.speed_features(vehicle_events(spark, sf_dir)))
    parts = training.withColumn("part", F.lit("training")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.select("event_id", "label", "part")


@_query
def speed_model_metrics(spark, sf_dir):
    """Coefficients and errors of the Spark ML pipeline, to the tolerance of its
    optimiser; how that got there (``speed.report``) is left out."""
    report = speed.report(spark, speed.train(vehicle_events(spark, sf_dir)))
    return _rounded_report(report.drop("iterations", "objective_history"), 4)


def _rounded_report(report: DataFrame, digits: int) -> DataFrame:
    # adding 0 makes a negative zero a zero
    return report.select(*[(F.round(c, digits) + 0.0).alias(c) for c in report.columns])


@_query
def speed_moment_model(spark, sf_dir):
    """The same model from one pass over the training rows."""
    return _rounded_report(speed.moment_report(vehicle_events(spark, sf_dir)), 7)


@_query
def speed_moment_model_light(spark, sf_dir):
    """A weaker penalty, under which every feature has a coefficient."""
    return _rounded_report(speed.moment_report(vehicle_events(spark, sf_dir), LIGHT_PENALTY), 7)


@_query
def speed_moment_predictions(spark, sf_dir):
    training, test = speed.split(speed.speed_features(vehicle_events(spark, sf_dir)))
    scored = speed.fit_moments(training, LIGHT_PENALTY).transform(test)
    return _plain_prediction(scored, 7)


def _plain_prediction(rows: DataFrame, digits: int = 4) -> DataFrame:
    return rows.select(
        vector_to_array("features").alias("features"), "label", F.round("prediction", digits).alias("prediction")
    )


@_query
def speed_predictions(spark, sf_dir):
    return _plain_prediction(speed.train(vehicle_events(spark, sf_dir)).predictions())


@_query
def speed_model_reloaded(spark, sf_dir):
    """Every event scored by the model after saving and loading it."""
    events = vehicle_events(spark, sf_dir)
    path = workspace(spark, "model")
    speed.train(events).save(path)
    return _plain_prediction(speed.load(path).transform(speed.speed_features(events)))


# --- text stream operators -------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = spark.read.schema("text string").parquet(f"{sf_dir}/documents.parquet")
    return textops.lines(texts, "text")


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textops.words(_lines(spark, sf_dir))


@_query
def text_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


@_query
def word_lengths(spark, sf_dir):
    """Length of every line."""
    return textops.line_lengths(_lines(spark, sf_dir))


@_query
def words(spark, sf_dir):
    return _words(spark, sf_dir)


@_query
def words_not_hello(spark, sf_dir):
    return textops.words_except(_words(spark, sf_dir))


@_query
def words_not_the(spark, sf_dir):
    """The same for a word that occurs."""
    return textops.words_except(_words(spark, sf_dir), "the")


@_query
def longest_word(spark, sf_dir):
    return textops.longest_word(_words(spark, sf_dir))


@_query
def word_count(spark, sf_dir):
    return textops.word_count(_words(spark, sf_dir))


@_query
def word_count_by_value(spark, sf_dir):
    return textops.count_by_value(_words(spark, sf_dir))


@_query
def word_count_desc(spark, sf_dir):
    return textops.swap(textops.by_count_descending(textops.count_by_value(_words(spark, sf_dir))))


@_query
def top_words(spark, sf_dir):
    return textops.top_words(textops.count_by_value(_words(spark, sf_dir)))


