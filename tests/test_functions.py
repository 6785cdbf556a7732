"""Hand-worked values of the scalar functions."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import (
    bounding_box,
    day_start,
    grid_box,
    grid_degree,
    haversine_km,
    in_interval,
    iso_weekday,
    parse_event_time,
    record_date,
    round_half_up,
    split_lines,
    split_words,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("degrees", "cell"),
    [
        (-5.2036514, -5.2035),
        (53.315853, 53.316),
        (-0.00025, 0.0),
        (0.00025, 0.0005),
        (0.0, 0.0),
    ],
)
def test_grid_box(spark, degrees, cell):
    assert value(spark, grid_box(F.lit(degrees))) == cell


@pytest.mark.parametrize(("degrees", "whole"), [(-5.2036514, -5.0), (53.315853, 53.0), (-0.4, 0.0)])
def test_grid_degree(spark, degrees, whole):
    result = value(spark, grid_degree(F.lit(degrees)))
    assert result == whole
    assert math.copysign(1, result) == (1 if whole == 0 else math.copysign(1, whole))


def test_grid_reads_text(spark):
    assert value(spark, grid_box(F.lit("53.315853"))) == 53.316


@pytest.mark.parametrize(("x", "rounded"), [(-0.5, 0), (0.5, 1), (-1.5, -1), (2.4999, 2), (-0.51, -1)])
def test_round_half_up(spark, x, rounded):
    assert value(spark, round_half_up(F.lit(x))) == rounded


@pytest.mark.parametrize(
    ("lat", "lon", "km"),
    [
        (53.877495, -6.50238, 0.0),
        (53.36, -6.263, 59.669439),
        (54.0, -7.0, 35.305278),
        (52.0, -7.0, 211.413013),
    ],
)
def test_haversine(spark, lat, lon, km):
    column = haversine_km(F.lit(lat), F.lit(lon), F.lit(53.877495), F.lit(-6.50238))
    assert round(value(spark, column), 6) == km


def test_haversine_of_antipodes_is_half_the_circumference(spark):
    column = haversine_km(F.lit(30.0), F.lit(20.0), F.lit(-30.0), F.lit(-160.0))
    assert value(spark, column) == pytest.approx(math.pi * 6371)


def test_bounding_box_touches_the_circle():
    lat_min, lat_max, lon_min, lon_max = bounding_box(53.877495, -6.50238, 100.0)
    assert lat_max - 53.877495 == pytest.approx(math.degrees(100 / 6371))
    assert 53.877495 - lat_min == pytest.approx(math.degrees(100 / 6371))
    # wider than the plain division by cos(latitude), as the circle is widest
    # a little nearer to the pole
    assert lon_max + 6.50238 > math.degrees(100 / 6371) / math.cos(math.radians(53.877495))
    assert lon_min < -6.50238 < lon_max


@pytest.mark.parametrize(("lat", "lon", "km"), [(89.9, 0, 50), (0, 179.9, 50), (0, -179.9, 50), (10, 10, 15000)])
def test_bounding_box_without_longitudes(lat, lon, km):
    assert bounding_box(lat, lon, km)[2:] == (None, None)


@pytest.mark.parametrize(("day", "number"), [("2026-11-30", 1), ("2024-01-07", 7), ("2024-01-03", 3)])
def test_iso_weekday(spark, day, number):
    assert value(spark, iso_weekday(F.lit(day).cast("date"))) == number


def test_day_start_and_record_date(spark):
    ts = F.lit("2024-01-03 23:59:59.999999").cast("timestamp")
    assert value(spark, day_start(ts)) == datetime(2024, 1, 3)
    assert value(spark, record_date(ts)) == "2024-01-03"


@pytest.mark.parametrize(
    ("text", "tz", "parsed"),
    [
        ("2024-01-03 10:11:12", None, datetime(2024, 1, 3, 10, 11, 12)),
        ("2024-01-03 10:11:12.345678", None, datetime(2024, 1, 3, 10, 11, 12, 345678)),
        ("2024-01-03 10:11:12", "America/Phoenix", datetime(2024, 1, 3, 17, 11, 12)),
        ("1465471124373", None, datetime(2016, 6, 9, 11, 18, 44, 373000)),
        ("1465471124373", "America/Phoenix", datetime(2016, 6, 9, 11, 18, 44, 373000)),
        ("soon", None, None),
        (None, None, None),
    ],
)
def test_parse_event_time(spark, text, tz, parsed):
    assert value(spark, parse_event_time(F.lit(text).cast("string"), tz)) == parsed


@pytest.mark.parametrize(("bounds", "kept"), [("half_open", [0, 1]), ("open", [1])])
def test_interval_ends(spark, bounds, kept):
    rows = spark.createDataFrame(
        [(0, datetime(2024, 1, 1)), (1, datetime(2024, 1, 1, 5)), (2, datetime(2024, 1, 2))], "n int, ts timestamp"
    )
    found = rows.filter(in_interval(F.col("ts"), "2024-01-01", "2024-01-02", bounds))
    assert sorted(r.n for r in found.collect()) == kept


def test_unknown_bounds_raise():
    with pytest.raises(ValueError, match="bounds"):
        in_interval(F.lit(1), "2024-01-01", "2024-01-02", "closed")


@pytest.mark.parametrize(
    ("text", "lines"),
    [
        ("a\nb", ["a", "b"]),
        ("a\nb\n", ["a", "b"]),
        ("a\r\nb\rc\n\n", ["a", "b", "c", ""]),
        ("", [""]),
        ("one", ["one"]),
    ],
)
def test_split_lines(spark, text, lines):
    assert value(spark, split_lines(F.lit(text))) == lines


@pytest.mark.parametrize(
    ("line", "words"),
    [
        ("a b", ["a", "b"]),
        (" a  b ", ["", "a", "", "b"]),
        ("", [""]),
        ("   ", []),
        ("tab\tstays", ["tab\tstays"]),
    ],
)
def test_split_words(spark, line, words):
    assert value(spark, split_words(F.lit(line))) == words
