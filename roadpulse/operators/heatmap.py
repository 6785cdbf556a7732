"""Counts per grid cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geo import cell_index, cell_to_degrees, degree_index, on_globe
from roadpulse.functions.times import day_start, event_time
from roadpulse.operators.traffic import AsOf, on_complete_days
from roadpulse.operators.windows import sliding_counts, sliding_counts_stream

# Length and slide of the live heat-map window, in seconds.
WINDOW_SECONDS = 120
SLIDE_SECONDS = 10


def measurements(events: DataFrame) -> DataFrame:
    """Position and time of each event."""
    return events.select(
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "ts",
    )


def _placed(points: DataFrame) -> DataFrame:
    """Points on the globe; the others have no cell."""
    return points.filter(on_globe(F.col("latitude"), F.col("longitude")))


def _cells(grid: str) -> list[Column]:
    """Grouping columns: whole numbers, which hash faster than coordinates."""
    lat, lon = cell_index(F.col("latitude")), cell_index(F.col("longitude"))
    if grid == "degree":
        lat, lon = degree_index(lat), degree_index(lon)
    elif grid != "box":
        raise ValueError(f"unknown grid {grid!r}: expected 'box' or 'degree'")
    return [lat.alias("lat_cell"), lon.alias("lon_cell")]


def _degrees(grid: str) -> list[Column]:
    def back(name):
        return F.col(name).cast("double") if grid == "degree" else cell_to_degrees(F.col(name))

    return [back("lat_cell").alias("latitude"), back("lon_cell").alias("longitude")]


def heatmap_daily(
    events: DataFrame, grid: str = "box", bounds: str = "half_open", include_last_day: bool = True
) -> DataFrame:
    """Events per day and cell; ``time_stamp`` is the start of the day.  With
    ``bounds="open"`` events at exactly midnight belong to no day."""
    if bounds not in ("half_open", "open"):
        raise ValueError(f"unknown bounds {bounds!r}: expected 'half_open' or 'open'")
    if not include_last_day:
        events = on_complete_days(events)
    points = _placed(measurements(events.filter(F.col("ts").isNotNull())))
    day = day_start(F.col("ts"))
    if bounds == "open":
        points = points.filter(F.col("ts") > day)
    counts = points.groupBy(day.alias("time_stamp"), *_cells(grid)).agg(
        F.count("*").alias("total_count")
    )
    return counts.select(*_degrees(grid), "total_count", "time_stamp")


def heatmap_window(events: DataFrame, grid: str = "box", as_of: AsOf = None) -> DataFrame:
    """Events per cell in 120-second windows every 10 seconds."""
    counts = sliding_counts(_placed(measurements(events)), _cells(grid), WINDOW_SECONDS, SLIDE_SECONDS)
    return window_rows(counts, grid, as_of)


def heatmap_window_stream(events: DataFrame, grid: str = "box") -> DataFrame:
    points = _placed(events.select("latitude", "longitude", "ts"))
    return sliding_counts_stream(points, _cells(grid), WINDOW_SECONDS, SLIDE_SECONDS)


def window_rows(counts: DataFrame, grid: str = "box", as_of: AsOf = None) -> DataFrame:
    return counts.select(
        *_degrees(grid),
        "total_count",
        event_time(as_of).alias("time_stamp"),
        "window_start",
        "window_end",
    )
