"""Plain SQL for the registered queries, for a second engine to check them.

Written from the definition of each operator and without the shortcuts the
Spark plans take: row-wise ``lag`` for the sightings, windows per event, plain
joins for the points of interest.
"""

from __future__ import annotations

from roadpulse.operators.poi import BATCH_POI, LIVE_POI, PointOfInterest
from roadpulse.operators.speed import ELASTIC_NET_PARAM, REG_PARAM, SEED, TRAINING_SHARE
from roadpulse.plans.queries import (
    AS_OF,
    DAY,
    INTERVAL,
    POINTS,
    TEST_POI,
    TOPIC_PARTITIONS,
    VIEW_TIME,
    LIGHT_PENALTY,
    LONG_VISIT_SECONDS,
    VIEW_TTL_SECONDS,
)
from roadpulse.schemas import ROUTES, VEHICLE_TYPES
from roadpulse.sources.testdata import VEHICLE_EVENTS_SQL
from roadpulse.sources.topic import TOPIC
from roadpulse.sources.viewstore import POI_TTL_SECONDS

VE = f"with ve as ({VEHICLE_EVENTS_SQL})"
EVENT_COLUMNS = (
    "event_id, vehicle_id, vehicle_type, route_id, latitude, longitude, ts, speed, fuel_level"
)
NOW = f"timestamp '{AS_OF}'"
NOW_DAY = f"'{AS_OF[:10]}'"
DATE = "strftime({}, '%Y-%m-%d')"
CELL = "floor({0} * 10000 / 5 + 0.5) * 5 / 10000"
DEGREE = "cast(trunc(floor({0} * 10000 / 5 + 0.5) * 5 / 10000) as bigint)::double"

SIGHTINGS = f"""
{VE}, gaps as (
  select *, lag(ts) over (partition by vehicle_id order by ts, event_id) as previous from ve
), sightings as (
  select {EVENT_COLUMNS} from gaps where previous is null or ts > previous + interval 3600 second
)"""


# Events that come last count as late if their minute ended ten minutes or more
# before the latest of the others.
_LATE = f"""(select * from ve where event_id % 10 = 3 and time_bucket(interval 60 second, ts) + interval 60 second
  <= (select max(ts) from ve where event_id % 10 <> 3) - interval 600 second)"""
_ON_TIME = f"""
{VE}, kept as (select * from ve where event_id not in (select event_id from {_LATE})
), gaps as (
  select *, lag(ts) over (partition by vehicle_id order by ts, event_id) as previous from kept
) select {EVENT_COLUMNS} from gaps where previous is null or ts > previous + interval 3600 second"""


def _speed_model(reg: float) -> str:
    """The elastic net by coordinate descent on covariances, 300 rounds."""
    x = ["lat", "lon", "dow"]
    names = [*x, "label"]
    sums = [f"avg({a}) as mean_{a}, stddev_pop({a}) as sd_{a}" for a in names]
    sums += [f"covar_pop({a}, {b}) as {a}_{b}" for i, a in enumerate(names) for b in names[i:]]
    pair = {(a, b): f"{a}_{b}" for i, a in enumerate(names) for b in names[i:]}

    def scaled(a: str, b: str) -> str:
        return f"{pair.get((a, b)) or pair[b, a]} / sd_{a} / sd_{b}"

    l1, l2 = (f"({reg * share!r} / sd_label)" for share in (ELASTIC_NET_PARAM, 1 - ELASTIC_NET_PARAM))
    step, turns = "select i, b_lat, b_lon, b_dow from descent where i < 300", "descent"
    for a in x:
        rest = " - ".join([f"({scaled(a, 'label')})", *[f"({scaled(a, b)}) * b_{b}" for b in x if b != a]])
        others = ", ".join(f"b_{b}" for b in x if b != a)
        new = f"sign({rest}) * greatest(abs({rest}) - {l1}, 0) / (({scaled(a, a)}) + {l2})"
        step = f"select i, {others}, {new} as b_{a} from ({step}), moments"
    return f"""with recursive ve as ({VEHICLE_EVENTS_SQL}), rows as (
  select event_id, speed as label, cast(trunc(latitude) as integer)::double as lat,
    cast(trunc(longitude) as integer)::double as lon, isodow(ts)::double as dow,
    cast('0x' || substr(md5(concat_ws('|', {SEED}, vehicle_id, epoch_us(ts), event_id)), 1, 8) as bigint) % 1000000
      < {int(TRAINING_SHARE * 1_000_000)} as training from ve
), moments as (select {", ".join(sums)} from rows where training
), descent as (
  select 0 as i, 0::double as b_lat, 0::double as b_lon, 0::double as b_dow
  union all select i + 1, b_lat, b_lon, b_dow from ({step})
), own as (
  select {", ".join(f"b_{a} * sd_label / sd_{a} as w_{a}" for a in x)}, mean_label, {", ".join(f"mean_{a}" for a in x)}
  from descent, moments where i = 300
), model as (select *, mean_label - {" - ".join(f"w_{a} * mean_{a}" for a in x)} as intercept from own
), scored as (select rows.*, intercept + {" + ".join(f"w_{a} * {a}" for a in x)} as prediction from rows, model
)"""


def _speed_report(reg: float, digits: int) -> str:
    parts = []
    for part, where in (("training", "training"), ("test", "not training")):
        missed = f"sum(pow(label - prediction, 2)) filter ({where})"
        count = f"count(*) filter ({where})"
        parts.append(f"round(sqrt({missed} / {count}), {digits}) + 0 as {part}_rmse")
        parts.append(f"round(1 - {missed} / ({count} * var_pop(label) filter ({where})), {digits}) + 0 as {part}_r2")
    weights = [f"round((select {w} from model), {digits}) + 0 as {name}" for w, name in (
        ("w_lat", "lat_coefficient"), ("w_lon", "long_coefficient"), ("w_dow", "day_coefficient"), ("intercept", "intercept")
    )]
    return f"{_speed_model(reg)} select {', '.join(weights + parts)} from scored"


def _speed_rows(reg: float, digits: int, where: str = "not training") -> str:
    return f"""{_speed_model(reg)} select [lat, lon, dow] as features, label,
  round(prediction, {digits}) as prediction from scored where {where}"""


def _distance(lat: str, lon: str) -> str:
    """Kilometres from an event to a point."""
    a = (
        f"(pow(sin(radians({lat} - latitude) / 2), 2) + cos(radians(latitude)) "
        f"* cos(radians({lat})) * pow(sin(radians({lon} - longitude) / 2), 2))"
    )
    return f"(6371 * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def _near(point: PointOfInterest) -> str:
    km = _distance(f"{point.latitude}e0", f"({point.longitude}e0)")
    where = f"{km} <= {point.radius_km}"
    if point.route:
        where += f" and route_id = '{point.route}'"
    if point.vehicle:
        where += f" and contains(vehicle_type, '{point.vehicle}')"
    return f"select *, {km} as km from ve where {where}"


_NEAR_COLUMNS = "round(km, 6) as distance_km, cast(trunc(km) as bigint) as distance"


def _poi(point: PointOfInterest) -> str:
    return f"{VE} select event_id, vehicle_id, vehicle_type, {_NEAR_COLUMNS} from ({_near(point)})"


def _text(value: str | None) -> str:
    return "null" if value is None else f"'{value}'"


def _poi_join() -> str:
    rows = ", ".join(
        f"('{p.poi_id}', {p.latitude}e0, {p.longitude}e0, {p.radius_km}e0, {_text(p.vehicle)}, {_text(p.route)})"
        for p in POINTS
    )
    km = _distance("p.lat", "p.lon")
    return f"""{VE}, p(poi_id, lat, lon, radius, vehicle, route) as (values {rows}),
pairs as (select ve.*, poi_id, {km} as km, radius from ve join p
  on (route is null or route_id = route) and (vehicle is null or contains(vehicle_type, vehicle)))
select event_id, vehicle_id, vehicle_type, poi_id, {_NEAR_COLUMNS} from pairs where km <= radius"""


def _latest_near(where: str = "true", point: PointOfInterest = LIVE_POI) -> str:
    return f"""select vehicle_id, vehicle_type, {_NEAR_COLUMNS}, ts as time_stamp from (
  select *, row_number() over (partition by vehicle_id order by ts desc, event_id desc) as rn
  from ({_near(point)}) where {where}) where rn = 1"""


def _visits(seconds: int) -> str:
    return f"""{VE}, near as (select vehicle_id, ts from ({_near(LIVE_POI)})), marked as (
  select *, ts > lag(ts) over (partition by vehicle_id order by ts) + interval {seconds} second as apart from near
), numbered as (
  select *, sum(case when apart then 1 else 0 end) over (partition by vehicle_id order by ts range unbounded preceding) as n from marked
) select vehicle_id, min(ts) as appeared_at, max(ts) + interval {seconds} second as vanished_at, count(*) as events
from numbered group by vehicle_id, n"""


def _windows(source: str, keys: str, length: int, slide: int) -> str:
    """Counts per key and window that covers the event."""
    copies = length // slide
    return f"""select {keys}, window_start,
  window_start + interval {length} second as window_end, count(*) as total_count
from (select *, time_bucket(interval {slide} second, ts) - to_seconds(k * {slide}) as window_start
      from {source}, range({copies}) as r(k)) group by all"""


def _traffic_windows(source: str) -> str:
    return f"""select route_id, vehicle_type, total_count, {NOW} as time_stamp,
  {DATE.format("window_start")} as record_date, window_start, window_end
from ({_windows(source, "route_id, vehicle_type", 30, 10)})"""


def _heat_windows(source: str, cell: str) -> str:
    keys = f"{cell.format('latitude')} as latitude, {cell.format('longitude')} as longitude"
    inner = f"(select {keys}, ts from {source})"
    return f"""select latitude, longitude, total_count, {NOW} as time_stamp, window_start, window_end
from ({_windows(inner, "latitude, longitude", 120, 10)})"""


def _heat_days(cell: str, where: str = "true") -> str:
    return f"""select {cell.format('latitude')} as latitude, {cell.format('longitude')} as longitude,
  count(*) as total_count, date_trunc('day', ts)::timestamp as time_stamp
from ve where {where} group by all"""


_COMPLETE = """ts >= (select date_trunc('day', min(ts)) from ve) and ts <
  (select date_trunc('day', min(ts)) + to_days(cast(floor((epoch_ms(max(ts)) - epoch_ms(min(ts)))
   / 86400000) as integer)) from ve)"""


def _daily(where: str = "true") -> str:
    return f"""select route_id, vehicle_type, count(*) as total_count, {NOW} as time_stamp,
  {DATE.format("ts")} as record_date from ve where {where} group by all"""


def _total(where: str = "true") -> str:
    return f"""select route_id, vehicle_type, count(*) as total_count, {NOW} as time_stamp,
  {NOW_DAY} as record_date from ve where {where} group by all"""


def _running(source: str, resets: str = "bucket > previous + interval 3600 second") -> str:
    return f""", counts as (
  select route_id, vehicle_type, time_bucket(interval 5 second, ts) as bucket, count(*) as n
  from {source} group by all
), steps as (
  select *, lag(bucket) over (partition by route_id, vehicle_type order by bucket) as previous from counts
), spells as (
  select *, sum(case when previous is null or {resets} then 1 else 0 end)
    over (partition by route_id, vehicle_type order by bucket) as spell from steps
), totals as (
  select route_id, vehicle_type, bucket, n, cast(sum(n)
    over (partition by route_id, vehicle_type, spell order by bucket) as bigint) as total_count
  from spells
)"""


_RUNNING_COLUMNS = "select route_id, vehicle_type, bucket, n, total_count from totals"
_VIEW = f"""{VE}{_running("ve")}, view as (
  select route_id, vehicle_type, total_count, bucket as time_stamp, {DATE.format("bucket")} as record_date
  from totals qualify row_number() over (
    partition by route_id, vehicle_type, {DATE.format("bucket")} order by bucket desc) = 1
)"""
_VIEW_COLUMNS = "select route_id, vehicle_type, total_count, time_stamp, record_date from view"

_PLACE = f"'{TOPIC}' as topic, cast(event_id % 4 as integer) as kafka_partition"
_OFFSET = "event_id // 4"
_ARCHIVE = f"""{VE} select vehicle_id, vehicle_type, route_id, latitude, longitude, ts, speed, fuel_level,
  {_PLACE}, cast(ts as date) as event_date, cast(isodow(ts) as integer) as day_of_week from ve"""
_FAULTY = "(vehicle_type in ('Small Truck', 'Taxi') or (vehicle_type = 'Bus' and route_id <> 'Route-82'))"
_NEXT_OFFSETS = f"select {_PLACE}, max({_OFFSET}) + 1 as until_offset from ve group by all"

_LINES = r"""with lines as (
  select unnest(regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) as value
  from documents
)"""
_WORDS = f"""{_LINES}, words as (
  select unnest(case when value = '' then [''] when rtrim(value, ' ') = '' then []
    else string_split(rtrim(value, ' '), ' ') end) as word from lines
)"""


def _pivot() -> str:
    columns = ", ".join(
        f"cast(coalesce(sum(case when vehicle_type = '{t}' then 1 end), 0) as bigint) as {t.lower().replace(' ', '_')}"
        for t in VEHICLE_TYPES
    )
    routes = ", ".join(f"'{r}'" for r in ROUTES)
    return f"{VE} select route_id, {columns} from ve where route_id in ({routes}) group by route_id"


def oracle() -> dict[str, str]:
    start, end = INTERVAL
    queries = {
        "total_traffic_batch": f"{VE} {_total()}",
        "daily_traffic": f"{VE} {_daily()}",
        "daily_traffic_complete_days": f"{VE} {_daily(_COMPLETE)}",
        "total_of_daily_traffic": f"{VE} {_total()}",
        "event_time_span": f"""{VE} select min(ts) as min_ts, max(ts) as max_ts,
            cast(floor((epoch_ms(max(ts)) - epoch_ms(min(ts))) / 86400000) as bigint) as span_days from ve""",
        "events_in_interval": f"""{VE} select event_id, vehicle_id, ts from ve
            where ts >= (select min(ts) from ve where ts >= timestamp '{start}') and ts < timestamp '{end}'""",
        "events_in_open_interval": f"""{VE} select event_id, vehicle_id, ts from ve
            where ts > (select min(ts) from ve where ts >= timestamp '{start}') and ts < timestamp '{end}'""",
        "window_traffic_30s_10s": f"{VE} {_traffic_windows('ve')}",
        "window_traffic_of_sightings": f"{SIGHTINGS} {_traffic_windows('sightings')}",
        "measurements": f"{VE} select latitude, longitude, ts from ve",
        "heatmap_daily": f"{VE} {_heat_days(CELL)}",
        "heatmap_daily_open": f"{VE} {_heat_days(CELL, _COMPLETE + ' and ts > date_trunc(' + chr(39) + 'day' + chr(39) + ', ts)')}",
        "heatmap_degree": f"{VE} {_heat_days(DEGREE)}",
        "heatmap_120s_10s": f"{VE} {_heat_windows('ve', CELL)}",
        "heatmap_of_sightings_degree": f"{SIGHTINGS} {_heat_windows('sightings', DEGREE)}",
        "poi_vehicles_live": _poi(LIVE_POI),
        "poi_vehicles_batch": _poi(BATCH_POI),
        "poi_vehicles_route_truck": _poi(TEST_POI),
        "poi_multi_join": _poi_join(),
        "poi_multi_join_salted": _poi_join(),
        "poi_latest_per_vehicle": f"{VE} {_latest_near()}",
        "first_sightings": f"{SIGHTINGS} select {EVENT_COLUMNS} from sightings",
        "first_per_vehicle_batch": f"""{VE} select {EVENT_COLUMNS} from ve qualify row_number() over (
            partition by vehicle_id, time_bucket(interval 5 second, ts) order by ts, event_id) = 1""",
        "first_per_vehicle_day": f"""{VE} select {EVENT_COLUMNS} from ve qualify row_number() over (
            partition by vehicle_id, date_trunc('day', ts) order by ts, event_id) = 1""",
        "total_traffic_running": f"{SIGHTINGS}{_running('sightings')} {_RUNNING_COLUMNS}",
        "total_traffic_running_all_events": f"{VE}{_running('ve')} {_RUNNING_COLUMNS}",
        "total_traffic_running_daily": VE
        + _running(
            "ve",
            "bucket > previous + interval 3600 second"
            " or date_trunc('day', bucket) > date_trunc('day', previous)",
        )
        + _RUNNING_COLUMNS,
        "counts_per_batch": f"{VE}{_running('ve')} select route_id, vehicle_type, bucket, n from counts",
        "json_messages": f"""{VE} select event_id, vehicle_id as key, route_id,
            strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as timestamp, latitude, speed from ve""",
        "json_roundtrip": f"""{VE} select vehicle_id, vehicle_type, route_id, latitude, longitude, ts, speed,
            fuel_level, cast(event_id % 4 as integer) as kafka_partition,
            {_OFFSET} as from_offset, {_OFFSET} + 1 as until_offset from ve""",
        "dead_letter_split": f"""{VE} select {_PLACE}, {_OFFSET} as "offset",
            case when vehicle_type = 'Bus' and route_id = 'Route-37' then 'bad_key'
              when vehicle_type = 'Bus' then 'future_timestamp'
              when vehicle_type = 'Taxi' and route_id = 'Route-37' then 'bad_number' when route_id = 'Route-37' then 'bad_json'
              when route_id = 'Route-43' then 'bad_timestamp' else 'bad_coordinate' end as error
            from ve where {_FAULTY}""",
        "good_after_faults": f"{VE} {_total(f'not ({_FAULTY})')}",
        "weekday_flatten": f"""{VE} select vehicle_id, {_OFFSET} as "offset", {_PLACE},
            min({_OFFSET}) over p as from_offset, max({_OFFSET}) over p + 1 as until_offset,
            cast(isodow(ts) as integer) as day_of_week
            from ve window p as (partition by event_id % 4)""",
        "archive_roundtrip": _ARCHIVE,
        "archive_pruned_scan": f"""{VE} select cast(event_id % 4 as integer) as kafka_partition,
            cast(ts as date) as event_date, count(*) as n, round(avg(speed), 6) as avg_speed
            from ve where isodow(ts) = 3 group by all""",
        "archive_compacted": f"""{VE}, d as (select cast(event_id % 4 as integer) as kafka_partition,
                cast(ts as date) as event_date, count(*) as n from ve group by all),
            l as (select *, event_date = date '{DAY}' - 1 and kafka_partition = 1 as late from d)
            select kafka_partition, event_date, case when late then 2 * n else n end as n,
                cast(case when event_date < date '{DAY}' and not late then 1 end as bigint) as files from l""",
        "archive_time_span": f"""{VE} select min(ts) as min_ts, max(ts) as max_ts,
            cast(floor((epoch_ms(max(ts)) - epoch_ms(min(ts))) / 86400000) as bigint) as span_days from ve""",
        "archived_offsets": f"{VE} {_NEXT_OFFSETS}",
        "latest_offsets": f"{VE} {_NEXT_OFFSETS}",
        "starting_offsets": f"""{VE}, o as ({_NEXT_OFFSETS}),
            p as (select cast(unnest(range({TOPIC_PARTITIONS})) as integer) as number)
            select '{{"{TOPIC}":{{' || string_agg('"' || number || '":' || coalesce(until_offset, -2), ',' order by number)
            || '}}}}' as offsets from p left join o on number = kafka_partition""",
        "delimited_rows": f"""{VE} select vehicle_id, vehicle_type, route_id, latitude, longitude,
            date_trunc('day', ts)::timestamp as ts, speed, fuel_level from ve""",
        "view_latest_per_key": f"{_VIEW} {_VIEW_COLUMNS}",
        "view_latest_ranked": f"{_VIEW} {_VIEW_COLUMNS}",
        "view_compacted": f"{_VIEW} {_VIEW_COLUMNS}",
        "view_by_date": f"{_VIEW} {_VIEW_COLUMNS} where record_date = '{DAY}'",
        "window_view_by_date": f"""{VE} select * from ({_traffic_windows('ve')})
            where record_date = '{DAY}'""",
        "window_view_newest": f"""{VE}, w as ({_traffic_windows('ve')})
            select * from w where window_start = (select max(window_start) from w)""",
        "heatmap_at_time": f"""{VE} select * from ({_heat_days(CELL)})
            where time_stamp = timestamp '{DAY}'""",
        "heatmap_points": f"{VE} select latitude, longitude from ({_heat_days(CELL)})",
        "poi_ttl_view": f"""{VE}, latest as ({_latest_near(f"ts <= timestamp '{VIEW_TIME}'")})
            select *, time_stamp + interval {VIEW_TTL_SECONDS} second as expires_at from latest
            where time_stamp + interval {VIEW_TTL_SECONDS} second > timestamp '{VIEW_TIME}'""",
        "store_column_names": f"""{VE} select route_id as routeid, vehicle_type as vehicletype,
            total_count as totalcount, time_stamp as timestamp, record_date as recorddate
            from ({_total()})""",
        "traffic_pivot": _pivot(),
        "route37_slice": f"""{VE} select vehicle_type, total_count from ({_total()})
            where route_id = 'Route-37'""",
        "snapshot_payload": f"""{_VIEW}, parts as (
            select 'totalTraffic' as view, record_date, route_id as tile from view where record_date = '{DAY}'
            union all select 'windowTraffic', record_date, route_id from ({_traffic_windows('ve')}) where record_date = '{DAY}'
            union all select 'poiTraffic', {DATE.format("time_stamp")}, vehicle_type from ({_latest_near()})
            union all select 'heatMap', {DATE.format("time_stamp")},
              cast(floor(latitude) as integer) || '|' || cast(floor(longitude) as integer) from ({_heat_days(CELL)})
            ) select view, record_date, tile, count(*) as rows from parts group by all""",
        "snapshot_total_rows": f"{_VIEW} {_VIEW_COLUMNS} where record_date = '{DAY}'",
        "snapshot_window_rows": f"""{VE} select * from ({_traffic_windows('ve')}) where record_date = '{DAY}'""",
        "snapshot_poi_rows": f"{VE} {_latest_near()}",
        "snapshot_heatmap_rows": f"{VE} {_heat_days(CELL)}",
        "snapshot_changed_tiles": f"""{_VIEW} select 'totalTraffic' as view, record_date, route_id as tile, count(*) as rows
            from view where record_date = (select max(record_date) from view) group by all""",
        "snapshot_current_rows": f"{_VIEW} {_VIEW_COLUMNS}",
        "stream_first_sightings": f"{SIGHTINGS} select {EVENT_COLUMNS} from sightings",
        "stream_total_traffic": f"{SIGHTINGS}{_running('sightings')} {_RUNNING_COLUMNS}",
        "stream_window_traffic": f"{SIGHTINGS} {_traffic_windows('sightings')}",
        "stream_heatmap": f"{SIGHTINGS} {_heat_windows('sightings', CELL)}",
        "live_total_traffic": f"""{SIGHTINGS}{_running("sightings")}
            select route_id, vehicle_type, total_count, bucket as time_stamp, {DATE.format("bucket")} as record_date
            from totals qualify row_number() over (
              partition by route_id, vehicle_type, {DATE.format("bucket")} order by bucket desc) = 1""",
        "stream_late_rows": f"{VE} select {EVENT_COLUMNS} from {_LATE}",
        "stream_sightings_on_time": _ON_TIME,
        "stream_poi": f"{VE} {_latest_near()}",
        "stream_poi_after_ttl": f"""{VE}, near as ({_latest_near()}) select * from near
            where time_stamp > (select max(time_stamp) from near) - interval 60 second""",
        "poi_visits": _visits(POI_TTL_SECONDS),
        "poi_visits_long": _visits(LONG_VISIT_SECONDS),
        "stream_poi_visits": _visits(POI_TTL_SECONDS),
        # two heartbeats come after the events, in a round of their own
        "stream_progress": f"""{VE} select 'archive' as stage, 3 as batches, count(*) + 2 as input_rows,
            0 as dropped_rows, 0 as gaps from ve""",
        "stream_archive": _ARCHIVE,
        "stream_ledger": f"""{VE} select {_PLACE}, min({_OFFSET}) as from_offset,
            max({_OFFSET}) + 1 as until_offset from ve group by all""",
        "stream_word_count": f"{_WORDS} select word, count(*) as count from words group by word",
        "batch_job_views": f"""{VE}, views as (
            select 'heat_map' as view, total_count as amount from ({_heat_days(CELL)})
            union all select 'poi_traffic', distance from ({_latest_near(point=TEST_POI)})
            union all select 'total_traffic', total_count from ({_total()})
            union all select 'window_traffic', total_count from ({_daily()}))
            select view, count(*) as rows, cast(sum(amount) as bigint) as amount from views group by view""",
        "speed_features": f"""{VE} select ts, event_id, vehicle_id, speed as label,
            cast(trunc(latitude) as integer) as lat, cast(trunc(longitude) as integer) as long,
            cast(isodow(ts) as integer) as "dayOfWeek",
            cast(latitude as varchar) || '|' || cast(longitude as varchar) as grid from ve""",
        "speed_split": f"""{VE}, draws as (select event_id, speed as label,
            cast('0x' || substr(md5(concat_ws('|', {SEED}, vehicle_id, epoch_us(ts), event_id)), 1, 8) as bigint)
              % 1000000 as draw from ve)
            select event_id, label, case when draw < {int(TRAINING_SHARE * 1_000_000)} then 'training' else 'test' end as part
            from draws""",
        "speed_model_metrics": _speed_report(REG_PARAM, 4),
        "speed_predictions": _speed_rows(REG_PARAM, 4),
        "speed_model_reloaded": _speed_rows(REG_PARAM, 4, "true"),
        "speed_moment_model": _speed_report(REG_PARAM, 7),
        "speed_moment_model_light": _speed_report(LIGHT_PENALTY, 7),
        "speed_moment_predictions": _speed_rows(LIGHT_PENALTY, 7),
        "text_lines": f"{_LINES} select value from lines",
        "word_lengths": f"{_LINES} select cast(length(value) as integer) as length from lines",
        "words": f"{_WORDS} select word from words",
        "words_not_hello": f"{_WORDS} select word from words where word <> 'hello'",
        "words_not_the": f"{_WORDS} select word from words where word <> 'the'",
        "longest_word": f"{_WORDS} select word from words order by length(word) desc, word limit 1",
        "word_count": f"{_WORDS} select word, count(*) as count from words group by word",
        "word_count_by_value": f"{_WORDS} select word, count(*) as count from words group by word",
        "word_count_desc": f"{_WORDS} select count(*) as count, word from words group by word",
        "top_words": f"""{_WORDS} select word, count(*) as count from words group by word
            order by count desc, word limit 10""",
    }
    return queries
