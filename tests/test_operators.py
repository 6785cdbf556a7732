"""Batch operators on small fixtures and against brute force."""

from __future__ import annotations

import contextlib
import io
import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import MIDDAY, at
from roadpulse.operators import heatmap, poi, running, serving, sightings, speed, textops, traffic
from roadpulse.operators.windows import newest_window, sliding_counts
from roadpulse.schemas import POI
from roadpulse.sources.viewstore import latest_per_key, latest_per_key_ranked

PROPERTY = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def plan_of(df, mode="simple") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


# --- sightings ---------------------------------------------------------------


def brute_sightings(rows, idle=3600):
    kept, last = set(), {}
    for event_id, vehicle, seconds, *_ in sorted(rows, key=lambda r: (r[2], r[0])):
        if vehicle not in last or seconds - last[vehicle] > idle:
            kept.add(event_id)
        last[vehicle] = seconds
    return kept


def test_gap_must_exceed_the_idle_time(events_of):
    rows = [(1, "a", 0), (2, "a", 3600), (3, "a", 7200.000001), (4, "b", 5)]
    found = {r.event_id for r in sightings.first_sightings(events_of(rows)).collect()}
    assert found == {1, 3, 4}


def test_equal_times_fall_back_to_the_event_id(events_of):
    found = sightings.first_sightings(events_of([(7, "a", 0), (3, "a", 0)])).collect()
    assert [r.event_id for r in found] == [3]


def test_vehicles_without_id_are_one_vehicle(events_of):
    assert sightings.first_sightings(events_of([(1, None, 0), (2, None, 10)])).count() == 1


@PROPERTY
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(0, 40_000)), min_size=1, max_size=60
    )
)
def test_sightings_match_brute_force(events_of, drawn):
    rows = [(i, v, s) for i, (v, s) in enumerate(drawn)]
    found = {r.event_id for r in sightings.first_sightings(events_of(rows)).collect()}
    assert found == brute_sightings(rows)


def test_carry_reads_only_what_is_asked(events_of):
    kept = sightings.first_sightings(events_of([(1, "a", 0)]), carry=["route_id"])
    assert set(kept.columns) == {"event_id", "vehicle_id", "ts", "route_id"}


def test_hot_vehicle_is_reduced_before_the_shuffle(events_of):
    """Times are hashed, before the shuffle and after it; nothing below the join
    that fetches the events sorts to aggregate."""
    plan = plan_of(sightings.first_sightings(events_of([(1, "a", 0)])))
    below = plan[plan.index("Join") :]
    assert "SortAggregate" not in below and below.count("HashAggregate") == 2
    last_exchange = plan.rindex("Exchange hashpartitioning")
    assert "partial_min(" in plan[last_exchange:] and "partial_max(" in plan[last_exchange:]


def test_equal_times_and_null_vehicles(spark, events_of):
    rows = [(5, "a", 0, "Route-82"), (4, "a", 0), (6, "b", 10), (7, "b", 4000), (8, "b", 4000)]
    events = events_of(rows).unionByName(events_of([(9, None, 50), (3, None, 20), (2, None, 9000)]))
    found = {(r.event_id, r.route_id) for r in sightings.first_sightings(events).collect()}
    assert found == {(4, "Route-37"), (6, "Route-37"), (7, "Route-37"), (3, "Route-37"), (2, "Route-37")}


def test_first_per_vehicle_and_interval(events_of):
    rows = [(1, "a", 0), (2, "a", 4.9), (3, "a", 5), (4, "b", 1)]
    found = {r.event_id for r in sightings.first_per_vehicle(events_of(rows)).collect()}
    assert found == {1, 3, 4}


# --- running totals ------------------------------------------------------------


def brute_running(rows, idle=3600, daily=False):
    counts = Counter()
    for _, _, seconds, route, kind in rows:
        instant = at(seconds)
        bucket = instant - timedelta(seconds=instant.second % 5, microseconds=instant.microsecond)
        counts[(route, kind, bucket)] += 1
    totals, last, out = defaultdict(int), {}, set()
    for (route, kind, bucket), n in sorted(counts.items(), key=lambda x: x[0][2]):
        key = (route, kind)
        before = last.get(key)
        if before is not None and (
            bucket - before > timedelta(seconds=idle) or (daily and bucket.date() > before.date())
        ):
            totals[key] = 0
        totals[key] += n
        last[key] = bucket
        out.add((route, kind, bucket, n, totals[key]))
    return out


@PROPERTY
@given(
    st.lists(
        st.tuples(
            # five days, so that carries, resets and gaps over midnight occur
            st.integers(0, 5 * 86_400),
            st.sampled_from(["Route-37", None]),
            st.sampled_from(["Bus", "Taxi"]),
        ),
        min_size=1,
        max_size=120,
    ),
    st.sampled_from([3600, 40_000]),
    st.booleans(),
)
def test_running_totals_match_brute_force(events_of, drawn, idle, daily):
    rows = [(i, "v", s, r, k) for i, (s, r, k) in enumerate(drawn)]
    result = running.running_totals(events_of(rows), idle, reset="daily" if daily else "idle")
    found = {tuple(r) for r in result.collect()}
    assert found == brute_running(rows, idle, daily)


def test_running_totals_reset_only_after_more_than_the_idle_time(events_of):
    rows = [(1, "v", 0), (2, "v", 3600), (3, "v", 7205)]
    found = sorted(r.total_count for r in running.running_totals(events_of(rows)).collect())
    assert found == [1, 1, 2]


def test_running_totals_read_the_events_once(events_of, spark, tmp_path):
    events_of([(i, "v", i * 1000) for i in range(50)]).write.parquet(str(tmp_path / "e"))
    totals = running.running_totals(spark.read.parquet(str(tmp_path / "e")))
    totals.collect()
    final = plan_of(totals).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final


# --- traffic and heat map --------------------------------------------------------


def test_last_incomplete_day_can_be_left_out(events_of):
    # midday, and two and a half days later: two whole days
    events = events_of([(1, "a", 0), (2, "a", 86_400), (3, "a", 2.5 * 86_400)])
    every = traffic.daily_traffic(events)
    complete = traffic.daily_traffic(events, include_last_day=False)
    assert sorted(r.record_date for r in every.collect()) == ["2024-01-03", "2024-01-04", "2024-01-06"]
    assert sorted(r.record_date for r in complete.collect()) == ["2024-01-03", "2024-01-04"]


def test_one_day_archive_has_no_complete_day(events_of):
    events = events_of([(1, "a", 0), (2, "a", 60)])
    assert traffic.daily_traffic(events, include_last_day=False).count() == 0
    assert heatmap.heatmap_daily(events, include_last_day=False).count() == 0


def test_complete_days_of_nothing(events_of, spark):
    empty = events_of([(1, "a", 0)]).limit(0)
    assert traffic.complete_days(empty) is None
    assert traffic.daily_traffic(empty, include_last_day=False).count() == 0


def test_open_bounds_drop_midnight(events_of):
    midnight = 12 * 3600
    events = events_of([(1, "a", midnight), (2, "a", midnight + 1)])
    assert heatmap.heatmap_daily(events).first().total_count == 2
    assert heatmap.heatmap_daily(events, bounds="open").first().total_count == 1


def test_cell_counts_add_up_to_the_events(events_of):
    rng = random.Random(3)
    rows = [
        (i, "a", rng.random() * 86_400, "Route-37", "Bus", rng.uniform(-60, 60), rng.uniform(-179, 179))
        for i in range(300)
    ]
    events = events_of(rows)
    for grid in ("box", "degree"):
        assert heatmap.heatmap_daily(events, grid).agg(F.sum("total_count")).first()[0] == 300
    with pytest.raises(ValueError, match="grid"):
        heatmap.heatmap_daily(events, "hexagon")


@PROPERTY
@given(
    st.lists(st.tuples(st.integers(-4000_000, 4000_000), st.sampled_from("ab")), min_size=1, max_size=60),
    st.sampled_from([(30, 10), (120, 10), (25, 10), (10, 10), (400, 5), (3000, 1000)]),
    st.sampled_from([0, 1, -60_000 * 86_400]),
)
def test_sliding_counts_match_brute_force(events_of, drawn, shape, shift):
    # around a full hour, where one stretch of panes ends and the next begins;
    # the last shift goes back before 1970
    length, slide = shape
    epoch = datetime(1970, 1, 1)
    want = Counter()
    for ms, route in drawn:
        us = (at(shift + ms / 1000) - epoch) // timedelta(microseconds=1)
        start = us - us % (slide * 1_000_000)
        while start > us - length * 1_000_000:
            want[(route, epoch + timedelta(microseconds=start))] += 1
            start -= slide * 1_000_000
    events = events_of([(i, "a", shift + ms / 1000, r) for i, (ms, r) in enumerate(drawn)])
    rows = sliding_counts(events, [F.col("route_id")], length, slide).collect()
    assert len(rows) == len(want)
    assert {(r.route_id, r.window_start): r.total_count for r in rows} == dict(want)
    assert all(r.window_end - r.window_start == timedelta(seconds=length) for r in rows)


def test_slide_may_not_exceed_the_window(events_of):
    with pytest.raises(ValueError, match="slide"):
        sliding_counts(events_of([(1, "a", 0)]), [F.col("route_id")], 10, 30)


def test_newest_window(events_of):
    view = traffic.window_traffic(events_of([(1, "a", 0), (2, "a", 100, "Route-43")]))
    rows = newest_window(view).collect()
    assert [(r.route_id, r.window_start) for r in rows] == [("Route-43", at(100))]


# --- points of interest ------------------------------------------------------------


def brute_km(lat1, lon1, lat2, lon2):
    a = (
        math.sin(math.radians(lat2 - lat1) / 2) ** 2
        + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 6371 * 2 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))


def brute_pairs(rows, points):
    return {
        (row[0], p.poi_id)
        for row in rows
        for p in points
        if brute_km(row[5], row[6], p.latitude, p.longitude) <= p.radius_km
        and (p.route is None or row[3] == p.route)
        and (p.vehicle is None or p.vehicle in row[4])
    }


def world(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 180)
        if i % 5 == 0:
            lon += 360  # the same place, written outside -180..180
        if i % 3 == 0:
            # a crowd in one spot near the antimeridian
            lat, lon = rng.uniform(-0.01, 0.01), 179.999 + rng.uniform(-0.01, 0.0009)
        kind = rng.choice(["Large Truck", "Bus"])
        rows.append((i, f"v{i % 7}", float(i), rng.choice(["Route-37", "Route-43"]), kind, lat, lon))
    return rows


POINTS = [
    poi.PointOfInterest(0.0, 180.0, 2.0, poi_id="edge"),
    poi.PointOfInterest(0.0, -179.9995, 1.0, poi_id="edge_west"),
    poi.PointOfInterest(90.0, 0.0, 3000.0, poi_id="pole"),
    poi.PointOfInterest(-45.0, 60.0, 2500.0, "Truck", "Route-37", "filtered"),
    poi.PointOfInterest(10.0, -30.0, 9000.0, poi_id="half_world"),
    poi.PointOfInterest(10.0, -30.0, 25000.0, poi_id="everything"),
    poi.PointOfInterest(20.0, 20.0, 0.0, poi_id="a_point"),
]


@pytest.mark.parametrize("broadcast_points", [100, 0])
def test_join_matches_brute_force(spark, events_of, broadcast_points):
    rows = world(5, 400)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if broadcast_points == 0 else threshold)
    try:
        joined = poi.near_points(events_of(rows), poi.poi_table(spark, POINTS), broadcast_points, parts=3)
        found = [(r.event_id, r.poi_id) for r in joined.collect()]
        plan = plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # beyond the limit the points' side is shuffled, only the square degrees are not
    assert ("SortMergeJoin" in plan) == (broadcast_points == 0)
    assert len(found) == len(set(found))
    assert set(found) == brute_pairs(rows, POINTS)


@pytest.mark.parametrize("point", POINTS, ids=lambda p: p.poi_id)
def test_one_point_matches_brute_force(events_of, point):
    rows = world(6, 300)
    found = {(r.event_id, point.poi_id) for r in poi.near_point(events_of(rows), point).collect()}
    assert found == brute_pairs(rows, [point])


def test_radius_is_inclusive(events_of):
    rows = [(1, "a", 0, "Route-37", "Bus", 53.36, -6.263)]
    exact = poi.near_point(events_of(rows), poi.LIVE_POI).first().distance_km
    centre = poi.LIVE_POI
    inside = poi.PointOfInterest(centre.latitude, centre.longitude, exact)
    outside = poi.PointOfInterest(centre.latitude, centre.longitude, exact - 1e-9)
    assert poi.near_point(events_of(rows), inside).count() == 1
    assert poi.near_point(events_of(rows), outside).count() == 0


def test_far_events_are_not_copied(spark, events_of):
    rows = [(i, "a", i, "Route-37", "Bus", lat, lon) for i, (lat, lon) in enumerate([(53.0, -7.0), (53.4, -7.2), (10.0, 10.0), (-89.9, 179.9)])]
    points = poi.poi_table(
        spark, [poi.PointOfInterest(53.0, -7.0, 1.0, poi_id="a"), poi.PointOfInterest(53.1, -7.1, 1.1, poi_id="b"), poi.PointOfInterest(10.2, 10.2, 40.0, poi_id="c")]
    )
    cells = poi._covering_cells(points)
    levels = sorted(r.level for r in cells.select("level").distinct().collect())
    assert len(levels) > 1
    placed = poi.placed_events(events_of(rows), cells, levels)
    copies = Counter(r.event_id for r in placed.collect())
    assert copies[3] == 0 and copies[2] == 1 and all(copies[i] <= len(levels) for i in (0, 1))


def test_crowded_cells_are_cut(spark):
    placed = spark.range(1000).select(F.when(F.col("id") < 500, F.lit(7)).otherwise(F.col("id")).alias("cell"))
    assert [tuple(r) for r in poi._pieces(placed, 10).collect()] == [(7, 5)]
    assert poi._pieces(placed.filter("false"), 10).collect() == []


def test_join_without_points(spark, events_of):
    assert poi.near_points(events_of([(1, "a", 0)]), poi.poi_table(spark, [])).count() == 0


def test_stored_distance_is_cut(events_of):
    near = poi.near_point(events_of([(1, "a", 0, "Route-37", "Bus", 53.36, -6.263)]), poi.LIVE_POI)
    row = poi.poi_rows(near, at(0)).first()
    assert (round(row.distance_km, 6), row.distance) == (59.669439, 59)


def test_one_row_per_vehicle(events_of):
    rows = [(1, "a", 0, "Route-37", "Bus", 53.8, -6.5), (2, "a", 9, "Route-37", "Bus", 53.9, -6.6)]
    latest = poi.latest_per_vehicle(poi.near_point(events_of(rows), poi.LIVE_POI)).collect()
    assert [(r.vehicle_id, r.time_stamp) for r in latest] == [("a", at(9))]


def test_box_of_a_point_reaches_the_scan(spark, events_of, tmp_path):
    events_of([(1, "a", 0)]).write.parquet(str(tmp_path / "e"))
    near = poi.near_point(spark.read.parquet(str(tmp_path / "e")), poi.LIVE_POI)
    pushed = plan_of(near, "formatted").split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(latitude" in pushed
    assert "LessThanOrEqual(longitude" in pushed


# --- views and serving ------------------------------------------------------------


def test_latest_per_key_both_ways(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 1, 1, "q"), (None, 1, 1, "n")],
        "k string, batch_id int, t int, v string",
    )
    want = {("a", "z"), ("b", "q"), (None, "n")}
    for function in (latest_per_key, latest_per_key_ranked):
        result = function(rows, ["k"], ["batch_id", "t"])
        assert result.columns == rows.columns
        assert {(r.k, r.v) for r in result.collect()} == want


def test_pivot_fills_gaps_and_ignores_unknown_routes(spark):
    totals = spark.createDataFrame(
        [("Route-37", "Bus", 3), ("Route-82", "Taxi", 4), ("Route-99", "Bus", 5), ("Route-37", "Tram", 6)],
        "route_id string, vehicle_type string, total_count bigint",
    )
    rows = {r.route_id: r.asDict() for r in serving.traffic_pivot(totals).collect()}
    assert set(rows) == {"Route-37", "Route-82"}
    assert rows["Route-37"] == {
        "route_id": "Route-37", "bus": 3, "large_truck": 0, "private_car": 0, "small_truck": 0, "taxi": 0
    }
    assert [r.total_count for r in serving.route_slice(totals).collect()] == [3, 6]


def places(spark, *rows):
    schema = "latitude double, longitude double, window_start timestamp, total_count bigint"
    return spark.createDataFrame([(lat, lon, at(second), n) for lat, lon, second, n in rows], schema)


def test_snapshot_documents_hold_every_row_once(spark):
    tiling = serving.TILINGS["heat_map"]
    view = places(spark, (53.1, -6.5, 0, 1), (53.9, -6.1, 0, 2), (-0.5, 0.5, 0, 3), (53.1, -6.5, 86_400.000001, 4))
    found = serving.snapshot({"heat_map": (view, tiling)})
    assert sorted((r.record_date, r.tile, r["rows"]) for r in found.collect()) == [
        ("2024-01-03", "-1|0", 1), ("2024-01-03", "53|-7", 2), ("2024-01-04", "53|-7", 1)
    ]
    schema = "latitude double, longitude double, window_start timestamp, total_count bigint"
    back = serving.unpack_snapshot(found, "heatMap", schema)
    assert back.exceptAll(view).count() == 0 and view.exceptAll(back).count() == 0
    assert serving.snapshot({"heat_map": (view.limit(0), tiling)}).count() == 0


def test_only_changed_documents_are_published(spark):
    tiling = serving.TILINGS["heat_map"]
    old = places(spark, (53.1, -6.5, 0, 1), (50.5, -6.1, 0, 2), (40.5, 1.5, 0, 3))
    new = places(spark, (53.1, -6.5, 0, 1), (50.5, -6.1, 0, 5), (60.5, 1.5, 0, 3))
    touched = places(spark, (50.5, -6.1, 0, 5), (60.5, 1.5, 0, 3), (53.1, -6.5, 0, 1))
    before = serving.documents(old, tiling)
    changed = serving.changed_documents(new, touched, before, tiling)
    assert {(r.tile, r["rows"]) for r in changed.collect()} == {("50|-7", 1), ("60|1", 1), ("40|1", 0)}
    both = before.withColumn("snapshot", F.lit(0)).unionByName(changed.withColumn("snapshot", F.lit(1)))
    now = serving.current_documents(both).select("record_date", "tile", "payload")
    assert now.exceptAll(serving.documents(new, tiling).select(now.columns)).count() == 0 and now.count() == 3


# --- text ---------------------------------------------------------------------------


def brute_words(line):
    if line == "":
        return [""]
    words = line.split(" ")
    while words and words[-1] == "":
        words.pop()
    return words


@PROPERTY
@given(st.lists(st.text("ab \t", max_size=8), min_size=1, max_size=20))
def test_words_match_brute_force(spark, lines):
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    words = textops.words(rows)
    want = [w for line in lines for w in brute_words(line)]
    assert sorted(r.word for r in words.collect()) == sorted(want)
    counts = {r.word: r["count"] for r in textops.word_count(words).collect()}
    assert counts == dict(Counter(want)) == {r.word: r["count"] for r in textops.count_by_value(words).collect()}
    longest = textops.longest_word(words).first().word
    assert longest == (min(want, key=lambda w: (-len(w), w)) if want else None)


def test_places_off_the_globe_are_left_out(spark, events_of):
    inf, nan = float("inf"), float("nan")
    odd = [(53.0, inf), (nan, -7.0), (1e300, -7.0), (None, -7.0), (53.0, 1e15)]
    events = events_of([(1, "a", 0, "Route-37", "Bus", 53.0, -7.0)])
    events = events.unionByName(
        events_of([(2 + k, "b", k, "Route-37", "Bus", *place) for k, place in enumerate(odd)])
    )
    assert [r.total_count for r in heatmap.heatmap_daily(events).collect()] == [1]
    points = spark.createDataFrame([("p", 53.0, -7.0, 5.0, None, None)], POI)
    assert [r.event_id for r in poi.near_points(events, points).collect()] == [1]


def test_order_of_counts(spark):
    rows = spark.createDataFrame([("hello you hello me",)], "value string")
    words = textops.words(rows)
    counts = textops.count_by_value(words)
    ordered = textops.swap(textops.by_count_descending(counts)).collect()
    assert [tuple(r) for r in ordered] == [(2, "hello"), (1, "me"), (1, "you")]
    assert [r.word for r in textops.top_words(counts, 1).collect()] == ["hello"]
    assert sorted(r.word for r in textops.words_except(words).collect()) == ["me", "you"]


def test_as_of_is_stamped(events_of):
    row = traffic.total_traffic(events_of([(1, "a", 0)]), "2024-05-06 07:08:09").first()
    assert (row.time_stamp, row.record_date) == (datetime(2024, 5, 6, 7, 8, 9), "2024-05-06")
    assert traffic.total_traffic(events_of([(1, "a", 0)])).first().time_stamp > MIDDAY


# --- speed model --------------------------------------------------------------------


def test_moment_model_is_the_pipelines(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        lat, lon, day = rng.randint(50, 60), rng.randint(-9, 3), rng.randint(1, 7)
        rows.append((i, float(5 * lat - 2 * lon + day + rng.gauss(0, 6)), lat, lon, day))
    table = spark.createDataFrame(rows, "event_id int, label double, lat int, long int, dayOfWeek int")
    fitted = speed.speed_pipeline().fit(table).stages[-1]
    model = speed.fit_moments(table)
    assert model.coefficients == pytest.approx(list(fitted.coefficients), abs=1e-6)
    assert model.intercept == pytest.approx(fitted.intercept, abs=1e-4)
    scored = model.transform(table).withColumn("part", F.lit("all"))
    rmse, r2 = scored.agg(*speed.errors("all")).first()
    assert (rmse, r2) == pytest.approx((fitted.summary.rootMeanSquaredError, fitted.summary.r2), abs=1e-6)
    assert len(model.transform(table).first().features) == 3


def test_moment_model_of_odd_tables(spark):
    table = spark.createDataFrame([(3.0, 1, 2, 3)] * 4, "label double, lat int, long int, dayOfWeek int")
    flat = speed.fit_moments(table)
    assert flat == speed.MomentModel((0.0, 0.0, 0.0), 3.0)
    assert speed.fit_moments(table.filter("false")) == speed.MomentModel((0.0, 0.0, 0.0), 0.0)
    # one feature varies, two are constant
    rows = [(float(2 * k), k, 5, 1) for k in range(20)]
    line = speed.fit_moments(spark.createDataFrame(rows, "label double, lat int, long int, dayOfWeek int"), 0.0)
    assert line.coefficients == pytest.approx((2.0, 0.0, 0.0)) and line.intercept == pytest.approx(0.0, abs=1e-9)


def test_visits_end_with_the_row(spark, events_of):
    near = events_of([(0, "a", 0), (1, "a", 120), (2, "a", 240.5), (3, "a", 250), (3, "a", 250), (4, "b", 5)])
    got = {(r.vehicle_id, r.appeared_at, r.vanished_at, r.events) for r in poi.visits(near).collect()}
    # an event at the moment the row would vanish keeps it
    assert got == {("a", at(0), at(240), 2), ("a", at(240.5), at(370), 3), ("b", at(5), at(125), 1)}
    assert {r.vehicle_id for r in poi.present(poi.visits(near), at(125)).collect()} == {"a"}
    assert poi.present(poi.visits(near), at(240)).count() == 0
    assert poi.visits(near.limit(0)).count() == 0
