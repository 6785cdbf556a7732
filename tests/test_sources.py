"""Messages, archive, offsets, delimited rows and the keyed views."""

from __future__ import annotations

import contextlib
import io
import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import at
from roadpulse import session
from roadpulse.operators import offsets, poi, traffic
from roadpulse.schemas import ARCHIVE, LEDGER, TOPIC_RECORD, VIEW_KEYS
from roadpulse.sources import archive, codec, compaction, delimited, footers, topic, viewstore

MESSAGE = {
    "vehicleId": "v1",
    "vehicleType": "Large Truck",
    "routeId": "Route-37",
    "latitude": "53.5",
    "longitude": "-7.25",
    "timestamp": "2024-01-03 10:11:12",
    "speed": 80.0,
    "fuelLevel": 28.0,
}


@pytest.fixture
def records_of(spark):
    def build(values, partition=0, first=0):
        rows = [
            (topic.TOPIC, partition, first + i, at(0), None, None if v is None else bytearray(v, "utf-8"))
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, TOPIC_RECORD)

    return build


def message(**changes):
    merged = {**MESSAGE, **changes}
    return json.dumps({k: v for k, v in merged.items() if v is not ...})


def test_good_message(records_of):
    row = codec.decode(records_of([message()], partition=2, first=40)).first()
    assert row.status == "ok" and row.error is None and row.raw_value is None
    assert (row.vehicle_id, row.latitude, row.longitude, row.speed) == ("v1", 53.5, -7.25, 80.0)
    assert (row.ts, row.event_date, row.day_of_week) == (datetime(2024, 1, 3, 10, 11, 12), date(2024, 1, 3), 3)
    assert (row.kafka_partition, row.offset, row.from_offset, row.until_offset) == (2, 40, 40, 41)


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ("{bad", "bad_json"),
        ("", "bad_json"),
        (None, "bad_json"),
        ("null", "bad_json"),
        ("[1]", "bad_json"),
        (message(timestamp="soon"), "bad_timestamp"),
        (message(timestamp=...), "bad_timestamp"),
        (message(latitude="north"), "bad_coordinate"),
        (message(longitude=None), "bad_coordinate"),
        (message(speed="fast"), "bad_number"),
        (message(speed="NaN"), "bad_number"),
        (message(timestamp=99999999999999999), "bad_timestamp"),
        (message(timestamp=-99999999999999999), "bad_timestamp"),
        (message(timestamp="2024-01-03 13:00:01"), "future_timestamp"),
        (message(timestamp="2099-01-01 00:00:00"), "future_timestamp"),
        (message(latitude="Infinity"), "bad_coordinate"),
        (message(longitude="NaN"), "bad_coordinate"),
        (message(latitude="90.5"), "bad_coordinate"),
        (message(longitude=1e15), "bad_coordinate"),
        (message(vehicleId=...), "bad_key"),
        (message(routeId=None), "bad_key"),
        (message(vehicleType=...), "bad_key"),
    ],
)
def test_bad_message_becomes_a_dead_letter(records_of, text, error):
    rows = codec.decode(records_of([text, message()]))
    dead = codec.dead_letters(rows).collect()
    assert [(r.offset, r.raw_value, r.error) for r in dead] == [(0, text, error)]
    assert codec.good(rows).count() == 1


def test_lenient_fields(records_of):
    texts = [
        message(latitude=53.5, speed="81.5"),
        message(speed=..., fuelLevel=None),
        message(timestamp=1465471124373),
        message(extra={"a": 1}),
    ]
    rows = codec.good(codec.decode(records_of(texts))).orderBy("offset").collect()
    assert [r.speed for r in rows] == [81.5, 0.0, 80.0, 80.0]
    assert rows[0].latitude == 53.5 and rows[1].fuel_level == 0.0
    assert rows[2].ts == datetime(2016, 6, 9, 11, 18, 44, 373000)


def test_source_zone(records_of):
    row = codec.decode(records_of([message()]), "Asia/Kolkata").first()
    assert row.ts == datetime(2024, 1, 3, 4, 41, 12)


def test_messages_are_parsed_once(records_of):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        codec.good(codec.decode(records_of([message()]))).explain()
    assert text.getvalue().count("from_json(") == 1


def test_encode_then_decode(events_of):
    events = events_of([(1, "a", 0.123456, "Route-43", "Taxi", 53.1234567, -7.7654321)])
    encoded = codec.encode(events)
    assert set(json.loads(encoded.first().value)) == set(MESSAGE)
    records = topic.as_topic_records(encoded, F.lit(0), F.col("event_id"))
    columns = ["vehicle_id", "vehicle_type", "route_id", "latitude", "longitude", "ts", "speed", "fuel_level"]
    assert codec.decode(records).select(columns).collect() == events.select(columns).collect()


def test_meta_map_round_trip(records_of):
    rows = archive.attach_offset_range(codec.decode(records_of([message()] * 3, partition=1, first=5)))
    mapped = archive.meta_map(rows)
    assert mapped.first().meta == {
        "topic": topic.TOPIC, "fromOffset": "5", "kafkaPartition": "1", "untilOffset": "8", "dayOfWeek": "3"
    }
    flat = archive.flatten_meta(mapped).select(sorted(rows.columns))
    assert flat.collect() == rows.select(sorted(rows.columns)).collect()


def test_offset_range_beyond_the_broadcast_limit(records_of):
    rows = codec.decode(records_of([message()] * 3).unionByName(records_of([message()], partition=1, first=9)))
    small, large = (
        archive.attach_offset_range(rows, n).select("kafka_partition", "offset", "from_offset", "until_offset")
        for n in (10, 1)
    )
    assert sorted(small.collect()) == sorted(large.collect())


def test_archive_layout_and_pruning(spark, records_of, tmp_path):
    path = str(tmp_path / "archive")
    archive.write_archive(codec.decode(records_of([message(), "{bad"])), path)
    archive.write_archive(codec.decode(records_of([message()], partition=1, first=12)), path)
    rows = archive.read_archive(spark, path)
    assert rows.schema == ARCHIVE and rows.count() == 3
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        codec.good(rows).filter("day_of_week = 3 and speed > 10").explain(mode="formatted")
    assert "day_of_week" in text.getvalue().split("PartitionFilters:")[1].split("\n")[0]
    assert "GreaterThan(speed,10.0)" in text.getvalue()
    assert offsets.saved_offsets(spark, path) == {topic.TOPIC: {0: 2, 1: 13}}


def test_offsets_compare_as_numbers(spark):
    rows = spark.createDataFrame(
        [("t", 0, "9"), ("t", 0, "10"), ("t", 1, "7")], "topic string, kafka_partition int, until_offset string"
    )
    assert {r.kafka_partition: r.until_offset for r in offsets.latest_offsets(rows).collect()} == {0: 10, 1: 7}


def test_only_a_missing_archive_counts_as_empty(spark, tmp_path):
    assert offsets.saved_offsets(spark, str(tmp_path / "none")) == {}
    (tmp_path / "plain.txt").write_text("not parquet")
    with pytest.raises(Exception) as raised:
        offsets.saved_offsets(spark, str(tmp_path / "plain.txt"))
    assert not isinstance(raised.value, AnalysisException) or "PATH" not in str(raised.value)


def test_offsets_from_the_ledger(spark, tmp_path):
    for batch, until in enumerate((5, 12)):
        rows = spark.createDataFrame([("t", 0, 0, until)], LEDGER)
        viewstore.upsert_batch(rows, str(tmp_path), batch)
    assert offsets.saved_offsets(spark, f"{tmp_path}/log", LEDGER) == {"t": {0: 12}}


def test_topic_options():
    assert topic.topic_options("kafka:9092") == {
        "kafka.bootstrap.servers": "kafka:9092",
        "kafka.group.id": "iot-data-event",
        "subscribe": "iot-data-event",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    resumed = topic.topic_options("k:1", saved_offsets={"iot-data-event": {1: 7, 0: 3}}, max_records=10)
    assert resumed["startingOffsets"] == '{"iot-data-event":{"0":3,"1":7}}'
    assert resumed["maxOffsetsPerTrigger"] == "10"


def test_start_names_every_partition_of_the_topic():
    saved = {"iot-data-event": {1: 7}, "other": {0: 9}}
    assert topic.start_of(saved, partitions=3) == {"iot-data-event": {0: -2, 1: 7, 2: -2}}
    assert topic.start_of(saved) == {"iot-data-event": {1: 7}}
    assert topic.start_of({"other": {0: 9}}, partitions=3) == {}
    assert topic.topic_options("k:1", saved_offsets={"other": {0: 9}}, partitions=3)["startingOffsets"] == "earliest"


def test_delimited_rows(spark, tmp_path):
    (tmp_path / "good.csv").write_text("2024-01-03,v1,Bus,Route-37,53.5,-7.25,80.0,20.0\n")
    row = delimited.read_delimited(spark, str(tmp_path / "good.csv")).first()
    assert (row.vehicle_id, row.ts, row.latitude) == ("v1", datetime(2024, 1, 3), 53.5)
    (tmp_path / "bad.csv").write_text("03/01/2024,v1,Bus,Route-37,53.5,-7.25,80.0,20.0\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        delimited.read_delimited(spark, str(tmp_path / "bad.csv")).collect()


# --- keyed views ---------------------------------------------------------------


def totals(spark, *rows):
    return spark.createDataFrame(
        [(r, "Bus", n, at(s), "2024-01-03") for r, n, s in rows],
        "route_id string, vehicle_type string, total_count bigint, time_stamp timestamp, record_date string",
    )


def current(spark, path):
    rows = viewstore.read_view(spark, path, VIEW_KEYS["total_traffic"]).collect()
    return {r.route_id: r.total_count for r in rows}


def test_last_batch_wins_and_replays_change_nothing(spark, tmp_path):
    path = str(tmp_path)
    viewstore.upsert_batch(totals(spark, ("a", 1, 0), ("b", 1, 0)), path, 0)
    viewstore.upsert_batch(totals(spark, ("a", 5, 1)), path, 9)
    viewstore.upsert_batch(totals(spark, ("a", 7, 2)), path, 10)
    viewstore.upsert_batch(totals(spark, ("a", 5, 1)), path, 9)
    assert current(spark, path) == {"a": 7, "b": 1}
    assert viewstore.read_changes(spark, path).count() == 4


def test_an_empty_batch_leaves_no_folder(spark, tmp_path):
    path = str(tmp_path)
    viewstore.upsert_batch(totals(spark), path, 0)
    assert current(spark, path) == {}
    viewstore.upsert_batch(totals(spark, ("a", 1, 0)), path, 1)
    viewstore.upsert_batch(totals(spark), path, 2)
    assert sorted(p.name for p in tmp_path.glob("log/*")) == ["batch_id=0", "batch_id=1"]
    assert current(spark, path) == {"a": 1}


def test_missing_view_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        viewstore.read_view(spark, str(tmp_path / "none"), ["k"])


def test_rows_expire_after_two_minutes(spark, events_of):
    near = poi.near_point(events_of([(1, "a", 0, "Route-37", "Bus", 53.8, -6.5)]), poi.LIVE_POI)
    rows = viewstore.with_expiry(poi.latest_per_vehicle(near))
    assert rows.first().expires_at == at(0) + timedelta(seconds=120)
    assert viewstore.unexpired(rows, at(119)).count() == 1
    assert viewstore.unexpired(rows, at(120)).count() == 0


def test_only_touched_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "view")

    def days(*rows):
        return spark.createDataFrame(list(rows), "n int, record_date string")

    viewstore.write_view(days((1, "2024-01-03"), (2, "2024-01-04")), path, ["record_date"])
    viewstore.write_view(days((3, "2024-01-04")), path, ["record_date"])
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 3]


def test_whole_view_is_replaced(spark, tmp_path):
    path = str(tmp_path / "view")
    for rows in ([(1, "2024-01-03"), (2, "2024-01-04")], [(3, "2024-01-04")]):
        viewstore.write_view(spark.createDataFrame(rows, "n int, record_date string"), path, ["record_date"], whole=True)
    assert [r.n for r in spark.read.parquet(path).collect()] == [3]


def test_workspace_needs_a_shared_folder_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.workspace(Cluster(), "x")
    assert "/roadpulse/x-" in session.workspace(spark, "x")


def test_footers_answer_for_offsets(spark, records_of, tmp_path):
    path = str(tmp_path / "archive")
    archive.write_archive(codec.decode(records_of([message(), "{bad"])), path)
    archive.write_archive(codec.decode(records_of([message()], partition=1, first=12)), path)
    want = {(r.kafka_partition, r.until_offset) for r in offsets.latest_offsets(archive.read_archive(spark, path)).collect()}
    assert {(r.kafka_partition, r.until_offset) for r in footers.archived_offsets(spark, path).collect()} == want == {(0, 2), (1, 13)}
    text = io.StringIO()
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with footers.footers_only(spark), contextlib.redirect_stdout(text):
        footers.folder_aggregates(spark, path, F.max("until_offset").alias("until_offset")).explain(mode="formatted")
    assert "PushedAggregation: [MAX(until_offset)]" in text.getvalue()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_span_of_an_archive(spark, records_of, tmp_path):
    path = str(tmp_path / "archive")
    archive.write_archive(codec.decode(records_of([message(), "{bad"])), path)
    rows = codec.good(archive.read_archive(spark, path))
    assert footers.archived_span(spark, path).collect() == traffic.event_time_span(rows).collect()
    empty = str(tmp_path / "dead")
    archive.write_archive(codec.decode(records_of(["{bad"])), empty)
    assert footers.archived_span(spark, empty).first().min_ts is None


def test_finished_days_are_compacted(spark, records_of, tmp_path):
    path, packed = str(tmp_path / "archive"), str(tmp_path / "packed")

    def files(table):
        return table.select(F.input_file_name()).distinct().count()

    for batch in range(5):
        archive.write_archive(codec.decode(records_of([message(), "{bad"], first=2 * batch)), path)
    rows = archive.read_archive(spark, path)
    day = codec.good(rows).agg(F.max("event_date")).first()[0]
    assert compaction.compact(spark, path, packed, str(day)) == 0
    assert compaction.read_compacted(spark, path, packed).count() == 10
    following = str(day + timedelta(days=1))
    assert compaction.compact(spark, path, packed, following) == 1
    assert compaction.compact(spark, path, packed, following) == 0
    both = compaction.read_compacted(spark, path, packed)
    assert sorted(both.select("offset", "status").collect()) == sorted(rows.select("offset", "status").collect())
    assert files(codec.good(both)) == 1 and files(codec.good(rows)) == 5
    # a late row: the folder is read from the archive until the next run
    archive.write_archive(codec.decode(records_of([message()], first=50)), path)
    late = compaction.read_compacted(spark, path, packed)
    assert late.filter("offset = 50").count() == 1 and late.count() == 11 and files(codec.good(late)) == 6
    assert compaction.compact(spark, path, packed, following) == 1
    again = compaction.read_compacted(spark, path, packed)
    assert again.count() == 11 and files(codec.good(again)) == 1
