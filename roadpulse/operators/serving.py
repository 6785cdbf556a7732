"""What the dashboard reads: by-date slices, chart data and the snapshot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.times import event_time
from roadpulse.schemas import ROUTES, VEHICLE_TYPES


def by_date(view: DataFrame, day: date | str) -> DataFrame:
    return view.filter(F.col("record_date") == str(day))


def at_time(view: DataFrame, instant: datetime | str) -> DataFrame:
    return view.filter(F.col("time_stamp") == event_time(instant))


def store_names(view: DataFrame) -> DataFrame:
    """Column names as the keyed store writes them: lower case, no underscores."""
    return view.toDF(*[c.replace("_", "").lower() for c in view.columns])


def traffic_pivot(totals: DataFrame) -> DataFrame:
    """Bar chart: one row per known route, one column per known type, 0 where a
    pair has no row."""
    known = totals.filter(F.col("route_id").isin(ROUTES))
    # the values are given, so no extra job looks them up
    table = known.groupBy("route_id").pivot("vehicle_type", VEHICLE_TYPES).agg(F.max("total_count"))
    return table.na.fill(0).toDF("route_id", *[t.lower().replace(" ", "_") for t in VEHICLE_TYPES])


def route_slice(totals: DataFrame, route: str = "Route-37") -> DataFrame:
    """Doughnut chart: counts by type on one route."""
    return totals.filter(F.col("route_id") == route).select("vehicle_type", "total_count")


def heatmap_points(view: DataFrame) -> DataFrame:
    return view.select("latitude", "longitude")


@dataclass(frozen=True)
class Tiling:
    """How a view is cut into documents: one per record date and tile.

    ``rows_move`` is true of views whose rows leave a tile without being written
    to: they expire, belong to an older window, or move on to another date."""

    name: str
    keys: tuple[str, ...]
    record_date: str
    tile: str
    rows_move: bool = False

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.struct(*self.keys, *[c for c in rows.columns if c not in self.keys]).alias("row"),
            F.expr(self.record_date).alias("record_date"),
            F.expr(self.tile).alias("tile"),
        )


DEGREE_TILE = "concat(cast(floor(latitude) as int), '|', cast(floor(longitude) as int))"
TILINGS = {
    "total_traffic": Tiling("totalTraffic", ("route_id", "record_date", "vehicle_type"), "record_date", "route_id"),
    "window_traffic": Tiling(
        "windowTraffic", ("route_id", "record_date", "vehicle_type", "window_start"), "record_date", "route_id", True
    ),
    # its rows have a distance from one point and no place
    "poi_traffic": Tiling("poiTraffic", ("vehicle_id",), "date_format(time_stamp, 'yyyy-MM-dd')", "vehicle_type", True),
    "heat_map": Tiling(
        "heatMap", ("latitude", "longitude", "window_start"), "date_format(window_start, 'yyyy-MM-dd')", DEGREE_TILE, True
    ),
}
DOCUMENT = "view string, record_date string, tile string, rows bigint, payload string"
PLACE = ["record_date", "tile"]


def documents(rows: DataFrame, tiling: Tiling) -> DataFrame:
    """A view as JSON: ``view, record_date, tile, rows, payload``, the payload
    being an array of row objects, sorted.  An array holds one route or square
    degree of one day, however large the view."""
    packed = tiling.placed(rows).groupBy(*PLACE).agg(
        F.count("*").alias("rows"), F.to_json(F.sort_array(F.collect_list("row")), JSON_TIME).alias("payload")
    )
    return packed.select(F.lit(tiling.name).alias("view"), *PLACE, "rows", "payload")


def snapshot(views: dict[str, tuple[DataFrame, Tiling]]) -> DataFrame:
    """All views as documents.  A view without rows has none."""
    return reduce(DataFrame.unionByName, [documents(rows, tiling) for rows, tiling in views.values()])


def current_documents(published: DataFrame) -> DataFrame:
    """The last published document of each tile; tiles without rows are left out."""
    newest = published.groupBy("view", *PLACE).agg(F.max_by(F.struct("rows", "payload"), "snapshot").alias("last"))
    return newest.select("view", *PLACE, "last.*").filter("rows > 0")


def changed_documents(rows: DataFrame, touched: DataFrame, before: DataFrame, tiling: Tiling) -> DataFrame:
    """Documents that differ from the published ones (``before``).

    ``touched``: rows written to the view since then.  Only their tiles are
    packed, and, where rows move, those that show something now.  A tile that
    lost all its rows gets an empty document."""
    shown = before.filter(F.col("view") == tiling.name)
    tiles = tiling.placed(touched).select(*PLACE)
    if tiling.rows_move:
        tiles = tiles.unionByName(shown.select(*PLACE))
    tiles = tiles.distinct()
    cut = rows.withColumns({"__date": F.expr(tiling.record_date), "__tile": F.expr(tiling.tile)})
    wanted = tiles.select(F.col("record_date").alias("__date"), F.col("tile").alias("__tile"))
    packed = documents(cut.join(wanted, ["__date", "__tile"], "left_semi").drop("__date", "__tile"), tiling)
    old = shown.select(*PLACE, F.col("payload").alias("old"))
    new = tiles.join(packed.drop("view"), PLACE, "left").join(old, PLACE, "left")
    new = new.select(
        F.lit(tiling.name).alias("view"),
        *PLACE,
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("payload", F.lit("[]")).alias("payload"),
        F.coalesce("old", F.lit("[]")).alias("old"),
    )
    return new.filter("payload <> old").drop("old")


def unpack_snapshot(published: DataFrame, name: str, view_schema: str) -> DataFrame:
    """Rows of one view, back from its documents."""
    rows = F.from_json("payload", f"array<struct<{view_schema}>>", JSON_TIME)
    return published.filter(F.col("view") == name).select(F.inline(rows))


# to the microsecond, so that a row comes back as it was
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
