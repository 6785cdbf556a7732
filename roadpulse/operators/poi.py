"""Vehicles near points of interest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.geo import EARTH_RADIUS_KM, bounding_box, haversine_km
from roadpulse.functions.times import event_time
from roadpulse.operators.sightings import event_order
from roadpulse.operators.traffic import AsOf
from roadpulse.schemas import POI, POI_VIEW
from roadpulse.sources.viewstore import POI_TTL_SECONDS, latest_per_key

# Cells of the many-points join are 2**level degrees wide.
MIN_LEVEL, MAX_LEVEL = -7, 9
CELLS_PER_POINT = 4
# Points up to this number are broadcast (some 100 bytes per cell); above it
# both sides are shuffled.
BROADCAST_POINTS = 100_000
# When both sides are shuffled, a cell with more than one part in so many of the
# events is cut into pieces of about that size.
PARTS = 2_000


@dataclass(frozen=True)
class PointOfInterest:
    latitude: float
    longitude: float
    radius_km: float
    vehicle: str | None = None
    route: str | None = None
    poi_id: str = "poi"


# The point the live job watches, and the point and the filters
# of the batch job.
LIVE_POI = PointOfInterest(53.877495, -6.50238, 100.0, poi_id="live")
BATCH_POI = PointOfInterest(33.877495, -95.50238, 30.0, "Truck", "Route-37", poi_id="batch")


def poi_table(spark: SparkSession, points: list[PointOfInterest]) -> DataFrame:
    rows = [(p.poi_id, p.latitude, p.longitude, p.radius_km, p.vehicle, p.route) for p in points]
    return spark.createDataFrame(rows, POI)


def near_point(events: DataFrame, poi: PointOfInterest) -> DataFrame:
    """Events within the radius (inclusive) of one point, with ``distance_km``.
    Works on batch and streaming input.

    The point is a literal, so there is no join; its bounding box consists of
    plain comparisons that reach the Parquet scan of an archive.
    """
    inside, distance = _inside(poi)
    return (
        events.filter(inside)
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= poi.radius_km)
    )


def near_point_on_clock(events: DataFrame, poi: PointOfInterest) -> DataFrame:
    """The same rows of a stream with a watermark.  A plain filter is moved below
    the watermark, whose clock would then stand still while nobody is near; rows
    left out by a generator carry it on."""
    inside, distance = _inside(poi)
    near = F.when(inside & (distance <= poi.radius_km), F.array(distance))
    return events.select("*", F.explode(near).alias("distance_km"))


def _inside(poi: PointOfInterest) -> tuple[Column, Column]:
    """Bounding box and filters of a point, and the distance to it."""
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    lat_min, lat_max, lon_min, lon_max = bounding_box(poi.latitude, poi.longitude, poi.radius_km)
    inside = (lat >= lat_min) & (lat <= lat_max)
    if lon_min is not None:
        # a longitude written outside -180..180 is left to the exact test
        inside = inside & (((lon >= lon_min) & (lon <= lon_max)) | (lon < -180) | (lon > 180))
    if poi.route is not None:
        inside = inside & (F.col("route_id") == poi.route)
    if poi.vehicle is not None:
        inside = inside & F.col("vehicle_type").contains(poi.vehicle)
    return inside, haversine_km(lat, lon, F.lit(poi.latitude), F.lit(poi.longitude))


# Longitudes up to this many degrees are turned back into range.
MOST_TURNED = 1e9


def _cell_key(level: Column, cell_y: Column, cell_x: Column) -> Column:
    """One number per level and cell, which joins faster than three columns.
    The finest level has 2 * 11520 rows and 2 * 23040 columns of cells."""
    row = (level - MIN_LEVEL).cast("bigint") * 32768 + cell_y + 16384
    return row * 65536 + cell_x + 32768


def _covering_cells(pois: DataFrame) -> DataFrame:
    """The cells each point's bounding box touches, at the level whose cells are
    at least as large as the box: four cells at most."""
    lat, lon = F.col("latitude"), F.col("longitude")
    arc = F.col("radius_km") / EARTH_RADIUS_KM
    d_lat = F.degrees(arc) + 1e-9
    at_pole = (lat - d_lat <= -90) | (lat + d_lat >= 90) | (arc >= F.lit(1.5707963267948966))
    d_lon = F.degrees(F.asin(F.sin(arc) / F.cos(F.radians(lat)))) + 1e-9
    all_lon = at_pole | (lon - d_lon < -180) | (lon + d_lon > 180)
    boxes = pois.withColumns(
        {
            "lat_min": F.greatest(lat - d_lat, F.lit(-90.0)),
            "lat_max": F.least(lat + d_lat, F.lit(90.0)),
            "lon_min": F.when(all_lon, F.lit(-180.0)).otherwise(lon - d_lon),
            "lon_max": F.when(all_lon, F.lit(180.0)).otherwise(lon + d_lon),
        }
    )
    extent = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"))
    level = F.least(
        F.greatest(F.ceil(F.log2(extent)).cast("int"), F.lit(MIN_LEVEL)), F.lit(MAX_LEVEL)
    )
    leveled = boxes.withColumn("level", level).withColumn("size", F.pow(F.lit(2.0), "level"))

    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / F.col("size")), F.floor(F.col(high) / F.col("size")))

    return (
        leveled.withColumn("cell_y", F.explode(span("lat_min", "lat_max")))
        .withColumn("cell_x", F.explode(span("lon_min", "lon_max")))
        .select(
            "level",
            "cell_y",
            "cell_x",
            _cell_key(F.col("level"), F.col("cell_y"), F.col("cell_x")).alias("cell"),
            "poi_id",
            "radius_km",
            F.col("vehicle").alias("poi_vehicle"),
            F.col("route").alias("poi_route"),
            F.col("latitude").alias("poi_latitude"),
            F.col("longitude").alias("poi_longitude"),
        )
    )


def _tile(lat: Column, lon: Column) -> Column:
    """Number of the square degree of a place: 181 rows of 361 at most."""
    return ((F.floor(lat) + 90) * 512 + F.floor(lon) + 180).cast("int")


def _occupied_levels(cells: DataFrame) -> DataFrame:
    """``tile, levels``: for each square degree the levels (as bits) that have a
    cell with a point in it.  There are at most 181 * 361 rows, whatever the
    number of points, so they can always be broadcast.  Cells larger than a
    degree are made distinct before they are spread over their degrees."""
    distinct = cells.select("level", "cell_y", "cell_x").distinct()
    size = F.pow(F.lit(2.0), "level")

    def degrees(cell: str, least: int, most: int) -> Column:
        low = F.floor(F.col(cell) * size)
        high = F.greatest(low, F.ceil((F.col(cell) + 1) * size) - 1)
        return F.sequence(F.greatest(low, F.lit(least)), F.least(high, F.lit(most)))

    spread = distinct.withColumn("y", F.explode(degrees("cell_y", -90, 90))).withColumn(
        "x", F.explode(degrees("cell_x", -180, 180))
    )
    bit = F.expr(f"shiftleft(1, level - ({MIN_LEVEL}))")
    return spread.groupBy(_tile(F.col("y"), F.col("x")).alias("tile")).agg(F.bit_or(bit).alias("levels"))


def _pieces(placed: DataFrame, parts: int) -> DataFrame:
    """``cell, pieces`` of the cells with more than one part in ``parts`` of the
    rows: fewer than ``parts`` of them, so they can be broadcast."""
    counts = placed.groupBy("cell").agg(F.count("*").alias("n"))
    total = placed.agg(F.count("*").alias("total"))
    # one row of totals
    share = F.greatest(F.lit(1.0), F.lit(total.first().total / parts))
    return counts.filter(F.col("n") > share).select("cell", F.ceil(F.col("n") / share).cast("int").alias("pieces"))


def placed_events(events: DataFrame, cells: DataFrame, levels: list[int]) -> DataFrame:
    """Events with the ``cell`` they are in, once for each level that has a point
    in the event's square degree; the others drop out without being copied."""
    lat = F.col("latitude").cast("double")
    lon = F.col("longitude").cast("double")
    wrapped = lon - 360.0 * F.floor((lon + 180.0) / 360.0)
    lon_in_range = F.when((lon >= -180) & (lon <= 180), lon).otherwise(wrapped)
    # turns around the globe are taken off; NaN is larger than any number
    on_earth = events.filter((lat >= -90) & (lat <= 90) & (F.abs(lon) <= MOST_TURNED))
    near = on_earth.withColumn("tile", _tile(lat, lon_in_range)).join(F.broadcast(_occupied_levels(cells)), "tile")
    places = [
        F.when(
            F.col("levels").bitwiseAND(F.lit(1 << (level - MIN_LEVEL))) != 0,
            _cell_key(F.lit(level), F.floor(lat / 2.0**level), F.floor(lon_in_range / 2.0**level)),
        )
        for level in levels or [0]
    ]
    return near.withColumn("cell", F.explode(F.array_compact(F.array(*places)))).drop("tile", "levels")


def near_points(
    events: DataFrame, pois: DataFrame, broadcast_points: int = BROADCAST_POINTS, parts: int = PARTS
) -> DataFrame:
    """Events joined to every point (``schemas.POI``) they are within the radius
    of, after the point's route and type filters: the event columns, ``poi_id``
    and ``distance_km``.

    An equi-join on grid cells narrows the candidates and the exact distance
    decides.  Every point lives on one level, so an event meets it in one cell
    only and no pair comes out twice.  A broadcast table of the square degrees
    that points reach drops far events first and names the levels the others are
    looked up on.  Up to ``broadcast_points`` points the events are not shuffled
    at all; beyond that the events per cell are counted, and a crowded cell is cut
    into as many pieces as it needs, so it does not end up in one task.  Events
    without a place on the globe are near nothing.  Points as wide as the globe
    meet every event: that many rows are the result.
    """
    cells = _covering_cells(pois)
    # at most MAX_LEVEL - MIN_LEVEL + 1 rows
    per_level = cells.groupBy("level").agg(F.count("*").alias("n")).collect()
    levels = sorted(r.level for r in per_level)
    few = sum(r.n for r in per_level) <= CELLS_PER_POINT * broadcast_points

    placed = placed_events(events, cells, levels)
    cells = cells.drop("level", "cell_y", "cell_x")
    keys = ["cell"]
    if few:
        right = F.broadcast(cells)
    else:
        pieces = F.broadcast(_pieces(placed.select("cell"), parts))
        number = F.coalesce("pieces", F.lit(1))
        spread = F.xxhash64(*event_order(events), "vehicle_id", "latitude", "longitude")
        placed = placed.join(pieces, "cell", "left").withColumn("piece", F.pmod(spread, number).cast("int")).drop("pieces")
        right = cells.join(pieces, "cell", "left").withColumn("piece", F.explode(F.sequence(F.lit(0), number - 1))).drop("pieces")
        keys = [*keys, "piece"]
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    distance = haversine_km(lat, lon, F.col("poi_latitude"), F.col("poi_longitude"))
    matched = F.col("poi_route").isNull() | (F.col("route_id") == F.col("poi_route"))
    matched = matched & (
        F.col("poi_vehicle").isNull() | F.col("vehicle_type").contains(F.col("poi_vehicle"))
    )
    return (
        placed.join(right, keys)
        .filter(matched)
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= F.col("radius_km"))
        .select(*events.columns, "poi_id", "distance_km")
    )


def poi_rows(near: DataFrame, as_of: AsOf | Column = None) -> DataFrame:
    """View rows: the exact distance and the whole kilometres that are stored."""
    return near.select(
        "vehicle_id",
        "vehicle_type",
        "distance_km",
        F.col("distance_km").cast("bigint").alias("distance"),
        event_time(as_of).alias("time_stamp"),
    )


def latest_per_vehicle(near: DataFrame) -> DataFrame:
    """The view keeps one row per vehicle: its last event near the point."""
    order = event_order(near)
    kept = near.select(
        "vehicle_id", "vehicle_type", "distance_km", *[c for c in order if c != "vehicle_id"]
    )
    rows = latest_per_key(kept, ["vehicle_id"], order)
    return poi_rows(rows, F.col("ts")).select([f.name for f in POI_VIEW.fields])


def visits(near: DataFrame, ttl_seconds: int = POI_TTL_SECONDS) -> DataFrame:
    """When each vehicle's row appears on the view and when it vanishes:
    ``vehicle_id, appeared_at, vanished_at, events``.

    A row vanishes ``ttl_seconds`` after the vehicle's last event near the point
    unless another one comes before or at that moment.  Works on batch and, with
    a watermark on ``ts``, on streaming input, where a visit is written once the
    watermark has passed its end.  Sessions are merged per task before the
    shuffle if ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    is set, which suits a vehicle with a large part of the events.  Events without
    a vehicle are one visitor; those without a time are left out."""
    stay = F.session_window("ts", f"{ttl_seconds} seconds").alias("stay")
    counted = near.groupBy("vehicle_id", stay).agg(F.count("*").alias("events"))
    return counted.select(
        "vehicle_id", F.col("stay.start").alias("appeared_at"), F.col("stay.end").alias("vanished_at"), "events"
    )


def present(rows: DataFrame, as_of: AsOf | Column) -> DataFrame:
    """Visits whose row shows at a time."""
    moment = event_time(as_of)
    return rows.filter((F.col("appeared_at") <= moment) & (F.col("vanished_at") > moment))
