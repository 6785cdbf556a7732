"""Geography as column expressions: no UDF, everything inside codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
# Boxes of the heat map: 0.0005 degrees, counted in units of 1/10000 degree.
BOX_UNITS = 5
UNITS_PER_DEGREE = 10000
_SLACK_DEGREES = 1e-9
MOST_DEGREES = 360.0


def on_globe(latitude: Column, longitude: Column) -> Column:
    """Is it a place: latitude within 90, longitude within 360 degrees?  False
    for null, NaN and infinite values."""
    place = (F.abs(latitude) <= 90.0) & (F.abs(longitude) <= MOST_DEGREES)
    return F.coalesce(place, F.lit(False))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km on a sphere of radius 6371 km."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # 1 - a can dip below zero by rounding for antipodes
    rest = F.greatest(F.lit(0.0), F.lit(1.0) - a)
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(rest)))


def bounding_box(latitude: float, longitude: float, radius_km: float):
    """``(lat_min, lat_max, lon_min, lon_max)`` around a circle; the longitudes
    are ``None`` when the circle reaches a pole or crosses the antimeridian."""
    arc = radius_km / EARTH_RADIUS_KM
    d_lat = math.degrees(arc) + _SLACK_DEGREES
    lat_min, lat_max = latitude - d_lat, latitude + d_lat
    if lat_min <= -90 or lat_max >= 90 or arc >= math.pi / 2:
        return lat_min, lat_max, None, None
    d_lon = math.degrees(math.asin(math.sin(arc) / math.cos(math.radians(latitude)))) + _SLACK_DEGREES
    lon_min, lon_max = longitude - d_lon, longitude + d_lon
    if lon_min < -180 or lon_max > 180:
        return lat_min, lat_max, None, None
    return lat_min, lat_max, lon_min, lon_max


def round_half_up(x: Column) -> Column:
    """Nearest whole number, ties toward plus infinity (``round`` sends -0.5
    away from zero instead)."""
    return F.floor(x + F.lit(0.5))


def cell_index(degrees: Column) -> Column:
    """Number of the 0.0005-degree box a coordinate falls in.  Group on this
    whole number and turn it back into degrees afterwards.  Null for what is no
    coordinate (not finite, or beyond ``MOST_DEGREES``)."""
    value = degrees.cast("double")
    # NaN is larger than any number
    return F.when(F.abs(value) <= MOST_DEGREES, round_half_up(value * UNITS_PER_DEGREE / BOX_UNITS))


def cell_to_degrees(index: Column, grid: str = "box") -> Column:
    """Coordinate of a box: its centre, or with ``grid="degree"`` the centre
    cut to a whole degree toward zero."""
    units = index * F.lit(BOX_UNITS)
    if grid == "box":
        return units / F.lit(float(UNITS_PER_DEGREE))
    if grid == "degree":
        return degree_index(index).cast("double")
    raise ValueError(f"unknown grid {grid!r}: expected 'box' or 'degree'")


def degree_index(index: Column) -> Column:
    """Whole degree of a box number, cut toward zero."""
    units = (index * F.lit(BOX_UNITS)).cast("double")
    return (units / F.lit(float(UNITS_PER_DEGREE))).cast("bigint")


def grid_box(degrees: Column) -> Column:
    """Coordinate snapped to the centre of its 0.0005-degree box."""
    return cell_to_degrees(cell_index(degrees))


def grid_degree(degrees: Column) -> Column:
    """Coordinate snapped to a box and then cut to whole degrees."""
    return cell_to_degrees(cell_index(degrees), "degree")
