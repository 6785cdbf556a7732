"""Streams against their batch twins: restarts, file splits, late rows, state."""

from __future__ import annotations

import json
import random
import time
from datetime import timedelta
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import at
from roadpulse.operators import heatmap, offsets, poi, running, serving, sightings, textops, traffic
from roadpulse.plans.jobs import live_snapshot, publish_changes, published, start_snapshots
from roadpulse.schemas import LEDGER, TRAFFIC_VIEW
from roadpulse.session import prepare
from roadpulse.sources import archive, codec, topic
from roadpulse.sources.viewstore import upsert_batch
from roadpulse.streaming import pipeline, progress, state, text_stream
from roadpulse.streaming.live import first_sightings_stream, running_totals_stream
from roadpulse.streaming.state import FirstSighting, FirstSightings, RunningTotal, RunningTotals

HOUR = 3600


def fleet(n=160, hours=9, seed=1):
    rng = random.Random(seed)
    rows = []
    for i, seconds in enumerate(sorted(rng.uniform(0, hours * HOUR) for _ in range(n))):
        # one vehicle sends a third of all events
        vehicle = "hot" if i % 3 == 0 else f"v{rng.randrange(12)}"
        kind = rng.choice(["Bus", "Large Truck"])
        rows.append((i, vehicle, seconds, rng.choice(["Route-37", "Route-43"]), kind, 53.8 + i % 7 / 1000, -6.5))
    return rows


def same(left, right):
    left, right = left.select(sorted(left.columns)), right.select(sorted(right.columns))
    assert left.exceptAll(right).collect() == []
    assert right.exceptAll(left).collect() == []


def drain(stream, root, name="rows"):
    writer = stream.writeStream.format("parquet").option("path", f"{root}/{name}")
    writer = writer.option("checkpointLocation", f"{root}/{name}-checkpoint").outputMode("append")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# --- state processors on their own ------------------------------------------------


class FakeState:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class FakeHandle:
    def __init__(self):
        self.state, self.timers = FakeState(), []

    def getValueState(self, name, schema):
        return self.state

    def registerTimer(self, millis):
        self.timers.append(millis)


def started(processor):
    handle = FakeHandle()
    processor.init(handle)
    return processor, handle


class BucketRow(SimpleNamespace):
    def __getitem__(self, name):
        return getattr(self, name)


def test_first_sighting_state():
    processor, handle = started(FirstSighting(3600_000_000, 5_000_000, ["n"]))

    def feed(*buckets):
        rows = [BucketRow(first_us=f, last_us=l, n=n) for f, l, n in buckets]
        return [r.n for r in processor.handleInputRows(("a",), iter(rows), None)]

    s = 1_000_000
    # out of order within a call; exactly an hour of silence is not enough
    assert feed((3604 * s, 3604 * s, "b"), (1 * s, 4 * s, "a")) == ["a"]
    assert feed((7204 * s + 1, 7205 * s, "c")) == ["c"]
    assert len(handle.timers) == 1
    # the first timer is early and is set anew, the second clears
    fired = handle.timers[0]
    list(processor.handleExpiredTimer(("a",), None, SimpleNamespace(getExpiryTimeInMs=lambda: fired)))
    assert handle.state.value is not None and len(handle.timers) == 2
    fired = handle.timers[1]
    assert fired > (7205 + 3600 + 5) * 1000
    list(processor.handleExpiredTimer(("a",), None, SimpleNamespace(getExpiryTimeInMs=lambda: fired)))
    assert handle.state.value is None
    assert feed((9000 * s, 9000 * s, "d")) == ["d"]


def test_first_sighting_state_takes_buckets_in_any_order():
    rng = random.Random(2)
    for _ in range(200):
        processor, _ = started(FirstSighting(100, 5, ["n"]))
        clock, last, want, got = 0, None, [], []
        for _ in range(3):  # calls follow each other in time
            rows = []
            for _ in range(rng.randrange(12)):
                clock += rng.choice([5, 50, 100, 101, 200])
                row = BucketRow(first_us=clock, last_us=clock + rng.randrange(4), n=clock)
                if last is None or row.first_us - last > 100:
                    want.append(row.n)
                last = row.last_us
                clock = last
                rows.append(row)
            rng.shuffle(rows)
            got += [r.n for r in processor.handleInputRows(("a",), iter(rows), None)]
        assert got == want


def test_running_total_state():
    processor, handle = started(RunningTotal(3600_000_000, 5_000_000, ["k"]))

    def feed(*buckets):
        rows = [BucketRow(bucket_us=b * 1_000_000, n=n, k="x") for b, n in buckets]
        return [r.total_count for r in processor.handleInputRows(("x",), iter(rows), None)]

    assert feed((5, 2), (0, 1)) == [1, 3]
    assert feed((3605, 4)) == [7]
    assert feed((7210, 1)) == [1]
    assert len(handle.timers) == 1
    # nothing to do if the state is gone already
    handle.state.clear()
    list(processor.handleExpiredTimer(("x",), None, SimpleNamespace(getExpiryTimeInMs=lambda: 1)))


def test_blocks_give_the_rows_of_single_keys(monkeypatch):
    """A group of vehicles in one state, in blocks of rows, against one state a
    vehicle; the same for totals."""
    monkeypatch.setattr(state, "HELD_ROWS", 8)
    monkeypatch.setattr(state, "BLOCK_ROWS", 3)
    rng = random.Random(4)
    for _ in range(60):
        group, handle = started(FirstSightings(100, 5))
        single = {v: started(FirstSighting(100, 5, ["event"]))[0] for v in ("", "=a", "=b")}
        totals, _ = started(RunningTotals(100, 5, ["k", "l"]))
        total, _ = started(RunningTotal(100, 5, ["k", "l"]))
        clock = 0
        for _ in range(4):
            rows = []
            for _ in range(rng.randrange(1, 30)):
                clock += rng.choice([5, 50, 100, 101, 200])
                last = clock + rng.randrange(4)
                rows.append({"vehicle": rng.choice(list(single)), "first_us": clock, "last_us": last, "event": str(clock)})
            rng.shuffle(rows)
            want = [
                r.event
                for v, p in single.items()
                for r in p.handleInputRows((v,), (BucketRow(**r) for r in rows if r["vehicle"] == v), None)
            ]
            blocks = (pd.DataFrame(rows[i : i + 4]) for i in range(0, len(rows), 4))
            mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: rng.choice([0, clock // 1000]))
            found = [e for block in group.handleInputRows((7,), blocks, mark) for e in block["event"]]
            assert sorted(found) == sorted(want)
            counts = [{"bucket_us": r["first_us"], "n": rng.randrange(1, 9), "k": "x", "l": None} for r in rows]
            want = [r.asDict() for r in total.handleInputRows(("x", None), (BucketRow(**r) for r in counts), None)]
            blocks = (pd.DataFrame(counts[i : i + 4]) for i in range(0, len(counts), 4))
            found = [r for block in totals.handleInputRows(("x", None), blocks, None) for r in block.to_dict("records")]
            assert found == want
            assert totals.state.value == total.state.value


def test_a_group_forgets_silent_vehicles():
    group, handle = started(FirstSightings(3600_000_000, 60_000_000))
    s, mark = 1_000_000, SimpleNamespace(getCurrentWatermarkInMs=lambda: 4000 * 1000)

    def feed(*rows):
        block = pd.DataFrame(rows, columns=["vehicle", "first_us", "last_us", "event"])
        return [e for found in group.handleInputRows((7,), iter([block]), mark) for e in found["event"]]

    assert feed(("=a", 0, 0, "a"), ("=b", 900 * s, 1000 * s, "b")) == ["a", "b"]
    assert handle.state.value == (["=b"], [1000 * s])
    assert handle.timers == [(1000 + 3600 + 60) * 1000 + 1]
    assert feed(("=b", 4600 * s, 4600 * s, "b")) == []
    fired = SimpleNamespace(getExpiryTimeInMs=lambda: handle.timers[-1])
    list(group.handleExpiredTimer((7,), mark, fired))
    assert len(handle.timers) == 2 and handle.state.value is not None
    list(group.handleExpiredTimer((7,), mark, fired))
    assert handle.state.value is None


# --- streams -------------------------------------------------------------------------


@pytest.mark.parametrize("files", [1, 5])
def test_sightings_and_totals_do_not_depend_on_the_split(spark, events_of, tmp_path, files):
    prepare(spark)
    rows = fleet()
    # up to five minutes of disorder, inside the watermark's ten
    rng = random.Random(9)
    arrival = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 300))
    source = str(tmp_path / "events")
    size = -(-len(arrival) // files)
    for i in range(files):
        events_of(arrival[i * size : (i + 1) * size]).coalesce(1).write.mode("append").parquet(source)
    # later events close the windows; the last one stays in the state
    events_of([(900, "beat", 40 * HOUR)]).coalesce(1).write.mode("append").parquet(source)
    events_of([(901, "beat", 80 * HOUR)]).coalesce(1).write.mode("append").parquet(source)

    events = events_of(rows)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    drain(first_sightings_stream(stream), tmp_path)
    found = spark.read.parquet(f"{tmp_path}/rows")
    twin = sightings.first_sightings(events)
    same(found.filter("event_id < 900"), twin)
    assert twin.count() < len(rows)

    stream = spark.readStream.schema(found.schema).parquet(f"{tmp_path}/rows")
    drain(running_totals_stream(stream), tmp_path, "totals")
    totals = spark.read.parquet(f"{tmp_path}/totals")
    same(totals, running.running_totals(twin))


def test_sightings_keep_every_value(spark, events_of, tmp_path):
    prepare(spark)
    rows = [(1, "a", 0.000001), (2, None, 1.234567), (3, 'q"\\\n', 2), (4, "", 3), (5, "beat", 40 * HOUR), (6, "beat", 80 * HOUR)]
    odd = {
        "route_id": "case when event_id = 1 then null when event_id = 2 then '' else route_id end",
        "speed": "case event_id when 1 then double('NaN') when 2 then double('-Infinity') when 3 then -0.1e0 end",
        "fuel_level": "event_id / 3",
        "sent_at": "ts + interval 1 microsecond",
        "local": "cast(ts as timestamp_ntz)",
        "day": "to_date(ts)",
        "amount": "cast(event_id / 7 as decimal(30, 20))",
        "raw": "cast(vehicle_id as binary)",
        "parts": "array(named_struct('at', ts, 'n', event_id), null)",
    }
    events = events_of(rows).withColumns({name: F.expr(sql) for name, sql in odd.items()})
    events.coalesce(1).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    drain(first_sightings_stream(stream), tmp_path)
    # rows after the watermark stay in the state
    same(spark.read.parquet(f"{tmp_path}/rows"), events.filter("event_id < 6"))


def test_late_rows_are_dropped_and_counted(spark, events_of, tmp_path):
    prepare(spark)
    source = str(tmp_path / "events")
    # lateness is judged by the watermark one batch back, hence the batch between
    batches = [(1, "a", 0)], [(2, "b", 2 * HOUR)], [(5, "b", 2 * HOUR + 1)], [(3, "c", 60)], [(4, "beat", 9 * HOUR)]
    for rows in batches:
        events_of(rows).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events_of([(0, "x", 0)]).schema)
    query = drain(first_sightings_stream(stream.option("maxFilesPerTrigger", 1).parquet(source)), tmp_path)
    found = {r.event_id for r in spark.read.parquet(f"{tmp_path}/rows").collect()}
    assert found == {1, 2}
    dropped = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    assert dropped == 1


def test_late_rows_are_set_aside(spark, events_of, tmp_path):
    """Rows that come after their minute was closed, over several runs: late ones
    in a table of their own, the others counted as if there were no late ones."""
    path, root = str(tmp_path / "topic"), str(tmp_path / "job")
    cfg = pipeline.LiveConfig(root, available_now=True, stages=["archive", "gate", "sightings"])
    first = [(1, "a", 0), (2, "b", 5 * HOUR), (3, "c", 5 * HOUR + 30)]
    # the watermark stands at 5 h - 9 min 30 s: 4 and 7 are late, 5 shares its minute with it
    later = [(4, "a", 2 * HOUR), (5, "d", 5 * HOUR - 570), (6, "a", 5 * HOUR - 500), (7, "e", 5 * HOUR - 631)]
    last = [(8, "b", 8 * HOUR), (9, "a", 60), (10, "beat", 40 * HOUR)]
    for batch in (first, later, last, [(11, "beat", 80 * HOUR)]):
        records = topic.as_topic_records(codec.encode(events_of(batch)), F.lit(0), F.col("event_id"))
        records.write.mode("append").parquet(path)
        pipeline.run_stream(spark, topic.topic_file_stream(spark, path), cfg)
    late = pipeline.late_rows(spark, cfg)
    assert late.columns == pipeline.SIGHTING_COLUMNS
    assert sorted(r.offset for r in late.collect()) == [4, 7, 9]
    seen = spark.read.parquet(cfg.table("sightings")).filter("vehicle_id != 'beat'")
    assert sorted((r.vehicle_id, r.offset) for r in seen.collect()) == [("a", 1), ("a", 6), ("b", 2), ("b", 8), ("c", 3), ("d", 5)]
    assert codec.good(archive.read_archive(spark, cfg.table("archive"))).count() == 11


def test_state_partitions_follow_the_cores(spark, events_of, tmp_path):
    """Each state partition costs a store, a worker and files in every batch."""
    setting, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    events = events_of(fleet(30))
    path = str(tmp_path / "topic")
    topic.as_topic_records(codec.encode(events), F.lit(0), F.col("event_id")).write.parquet(path)
    cfg = pipeline.LiveConfig(str(tmp_path / "live"), available_now=True, stages=["archive", "gate", "sightings"])
    try:
        spark.conf.set(setting, 7 * cores)
        pipeline.run_stream(spark, topic.topic_file_stream(spark, path), cfg)
        assert spark.conf.get(setting) == str(7 * cores)
    finally:
        spark.conf.set(setting, before)
    for stage in ("gate", "sightings"):
        state = tmp_path / "live" / "checkpoints" / stage / "state" / "0"
        assert sorted(p.name for p in state.iterdir() if p.name.isdigit()) == sorted(map(str, range(cores)))


def test_stages_that_read_the_same_table_run_side_by_side(spark, tmp_path, monkeypatch):
    log, listening = [], []
    cfg = pipeline.LiveConfig(str(tmp_path / "live"), available_now=True)

    def starter(name):
        def ended():
            if ("ended", name) not in log:
                log.append(("ended", name))
            if name == failing:
                raise RuntimeError(name)

        def start(*_):
            log.append(("started", name))
            return SimpleNamespace(awaitTermination=ended, stop=lambda: log.append(("stopped", name)))

        return start

    recorder = SimpleNamespace(finish=lambda: None)
    monkeypatch.setattr(pipeline, "ProgressRecorder", lambda *_: recorder)
    monkeypatch.setattr(type(spark.streams), "addListener", lambda _, x: listening.append(x))
    monkeypatch.setattr(type(spark.streams), "removeListener", lambda _, x: listening.remove(x))
    for stage in cfg.stages:
        monkeypatch.setattr(pipeline, f"start_{stage}", starter(stage))
    failing = None
    assert len(pipeline.run_stream(spark, None, cfg)) == len(cfg.stages)
    for stage, read in pipeline.READS.items():
        assert log.index(("ended", read)) < log.index(("started", stage))
    for beside in (["ledger", "poi_traffic", "gate"], ["poi_visits", "sightings"], ["total_traffic", "window_traffic", "heat_map"]):
        ends = [log.index(("ended", stage)) for stage in beside]
        assert max(log.index(("started", stage)) for stage in beside) < min(ends)
    log.clear()
    listening.clear()
    failing = "gate"
    with pytest.raises(RuntimeError):
        pipeline.run_stream(spark, None, cfg)
    assert ("stopped", "ledger") in log and ("started", "sightings") not in log and not listening


def test_a_backlog_leaves_no_log_of_changes(spark, events_of, tmp_path):
    """A restart would read and apply it before its first row."""
    events, path = events_of(fleet(30)), str(tmp_path / "topic")
    topic.as_topic_records(codec.encode(events), F.lit(0), F.col("event_id")).write.parquet(path)
    cfg = pipeline.LiveConfig(str(tmp_path / "live"), available_now=True, stages=["archive", "gate", "sightings"])
    pipeline.run_stream(spark, topic.topic_file_stream(spark, path), cfg)
    state = tmp_path / "live" / "checkpoints" / "sightings" / "state"
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.changelog"))
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled") == "true"


def test_no_batches_without_rows_where_they_would_do_nothing(spark, events_of, tmp_path, monkeypatch):
    """The gate keeps no state and the window views emit what rows have changed;
    sightings need the batch that the watermark closes.  Tables are made once."""
    made, make = [], pipeline._ensure_tables
    monkeypatch.setattr(pipeline, "_ensure_tables", lambda *a: (made.append(1), make(*a)))
    path = str(tmp_path / "topic")
    cfg = pipeline.LiveConfig(
        str(tmp_path / "live"), available_now=True, stages=["archive", "gate", "sightings", "window_traffic", "heat_map"]
    )
    for batch in (fleet(30), [(900, "beat", 40 * HOUR), (901, "beat2", 80 * HOUR)]):
        records = topic.as_topic_records(codec.encode(events_of(batch)), F.lit(0), F.col("event_id"))
        records.coalesce(1).write.mode("append").parquet(path)
        pipeline.run_stream(spark, topic.topic_file_stream(spark, path), cfg)
    batches = {
        stage: sorted(int(p.name) for p in (tmp_path / "live" / "checkpoints" / stage / "commits").iterdir() if p.name.isdigit())
        for stage in cfg.stages
    }
    assert batches == {
        "archive": [0, 1], "gate": [0, 1], "sightings": [0, 1, 2, 3], "window_traffic": [0, 1], "heat_map": [0, 1],
    }
    assert made == [1]
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    seen = spark.read.parquet(cfg.table("sightings")).drop("event_date").filter("vehicle_id not like 'beat%'")
    twin = sightings.first_sightings(codec.good(archive.read_archive(spark, cfg.table("archive"))).select(pipeline.SIGHTING_COLUMNS))
    same(seen, twin.filter("vehicle_id not like 'beat%'"))


def test_whole_job_with_restart(spark, events_of, tmp_path):
    rows = fleet(120)
    beats = [(900, "beat", 40 * HOUR), (901, "beat", 80 * HOUR)]
    path = str(tmp_path / "topic")

    def send(batch, first, extra=None):
        messages = codec.encode(events_of(batch))
        records = topic.as_topic_records(messages, F.lit(first % 2), F.col("event_id"))
        if extra:
            records = records.withColumn("value", F.lit(extra).cast("binary"))
        records.coalesce(1).write.mode("append").parquet(path)

    root = str(tmp_path / "job")
    cfg = pipeline.LiveConfig(root, available_now=True)

    def run():
        records = topic.topic_file_stream(spark, path, maxFilesPerTrigger="1")
        return pipeline.run_stream(spark, records, cfg)

    send(rows[:60], 0)
    assert not pipeline.has_checkpoint(spark, cfg)
    queries = run()
    assert pipeline.has_checkpoint(spark, cfg)
    assert [q.name for q in queries] == cfg.stages
    # the job goes on from its checkpoints
    send([(500, "x", 0)], 1, "{bad")
    send(rows[60:], 1)
    send(beats[:1], 0)
    send(beats[1:], 1)
    run()

    columns = pipeline.SIGHTING_COLUMNS
    stored = archive.read_archive(spark, cfg.table("archive"))
    good = codec.good(stored).select(columns)
    assert good.count() == len(rows) + 2
    assert [r.error for r in codec.dead_letters(stored).collect()] == ["bad_json"]
    real = good.filter("vehicle_id != 'beat'")

    ledger = pipeline.live_view(spark, cfg, "ledger")
    assert {r.kafka_partition: r.until_offset for r in ledger.collect()} == {0: 901, 1: 902}
    want = {topic.TOPIC: {0: 901, 1: 902}}
    assert offsets.saved_offsets(spark, cfg.table("archive")) == want
    assert offsets.saved_offsets(spark, f"{cfg.table('ledger')}/log", LEDGER) == want

    seen = spark.read.parquet(cfg.table("sightings")).drop("event_date")
    twin = sightings.first_sightings(real)
    same(seen.filter("vehicle_id != 'beat'"), twin)

    done = progress.read_progress(spark, cfg.table("progress"))
    report = {r.stage: r for r in progress.progress_summary(done).collect()}
    assert set(report) == set(cfg.stages)
    assert report["archive"].input_rows == len(rows) + 3
    assert report["archive"].batches == 5
    assert all(r.gaps == 0 and r.dropped_rows == 0 for r in report.values())

    stays = pipeline.poi_visits(spark, cfg)
    same(stays.filter("vehicle_id != 'beat'"), poi.visits(poi.near_point(real, poi.LIVE_POI)))

    near = poi.latest_per_vehicle(poi.near_point(good.filter("vehicle_id != 'beat'"), poi.LIVE_POI))
    last = max(r[2] for r in rows)
    shown = pipeline.live_view(spark, cfg, "poi_traffic", at(last))
    same(
        shown.filter("vehicle_id != 'beat'"),
        near.filter(F.col("time_stamp") > F.lit(at(last) - timedelta(seconds=120))),
    )
    assert shown.filter("vehicle_id != 'beat'").count() >= 1

    totals = pipeline.live_view(spark, cfg, "total_traffic")
    same(totals, pipeline.total_rows(running.running_totals(twin)).select(totals.columns))

    # the first heartbeat was let through as a sighting
    every = seen.unionByName(seen.limit(0))
    for name, batch in (
        ("window_traffic", traffic.window_traffic(every)),
        ("heat_map", heatmap.heatmap_window(every)),
    ):
        view = pipeline.live_view(spark, cfg, name, newest_only=False).drop("time_stamp")
        same(view, batch.drop("time_stamp"))
        newest = pipeline.live_view(spark, cfg, name)
        assert newest.select("window_start").distinct().count() == 1

    documents = live_snapshot(spark, cfg, "2024-01-03", at(last))
    found = {}
    for r in documents.collect():
        found.setdefault(r.view, []).extend(json.loads(r.payload))
    assert set(found) == {"totalTraffic", "windowTraffic", "poiTraffic", "heatMap"}
    assert len(found["totalTraffic"]) == totals.filter("record_date = '2024-01-03'").count()
    assert all(found.values())

    out = str(tmp_path / "snapshots")
    start_snapshots(spark, cfg, out, at(last)).awaitTermination()
    first = published(spark, out)
    whole = live_snapshot(spark, cfg, as_of=at(last))
    same(serving.current_documents(first), whole)
    # nothing has changed but the time: rows near the point have expired
    publish_changes(spark, cfg, out, 7, at(last + 10_000))
    again = published(spark, out).filter("snapshot = 7").collect()
    assert {(r.view, r["rows"]) for r in again} == {("poiTraffic", 0)}


def test_progress_of_foreign_and_ended_queries_is_left_out(spark, tmp_path):
    recorder = progress.ProgressRecorder(spark, str(tmp_path / "p"), ["mine"], flush_seconds=0)

    def report(run, name, rows, dropped=0, batch=0):
        source = SimpleNamespace(numInputRows=rows, startOffset=None, endOffset='{"logOffset":1}')
        state = SimpleNamespace(numRowsDroppedByWatermark=dropped, numRowsTotal=4)
        recorder.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(
            runId=run, name=name, batchId=batch, sources=[source], stateOperators=[state],
            durationMs={"triggerExecution": 7}, timestamp="2024-01-03T12:00:00.000Z")))

    report("r1", "mine", 9)
    recorder.onQueryStarted(SimpleNamespace(runId="r1", name="mine"))
    recorder.onQueryStarted(SimpleNamespace(runId="r2", name="other"))
    report("r2", "other", 9)
    report("r1", "mine", 0)
    report("r1", "mine", 5)
    report("r1", "mine", 0, dropped=2, batch=1)
    recorder.onQueryTerminated(SimpleNamespace(runId="r1"))
    recorder.onQueryStarted(SimpleNamespace(runId="r3", name="mine"))
    report("r3", "mine", 9, batch=2)
    assert recorder.done.is_set()
    kept = progress.read_progress(spark, str(tmp_path / "p")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.dropped_rows, r.state_rows, r.from_offset) for r in kept] == [
        (0, 5, 0, 4, None), (1, 0, 2, 4, None)
    ]
    assert progress.read_progress(spark, str(tmp_path / "none")).count() == 0


def test_snapshots_do_not_wait_for_a_view(spark, tmp_path):
    """The clock fires before any view has rows, and a view written later shows."""
    cfg = pipeline.LiveConfig(str(tmp_path / "job"))
    out = str(tmp_path / "snapshots")
    query = start_snapshots(spark, cfg, out, every_seconds=1)
    try:
        for _ in range(120):
            if query.lastProgress:
                break
            time.sleep(0.5)
        assert published(spark, out).count() == 0
        rows = spark.createDataFrame([("Route-37", "Bus", 4, at(0), "2024-01-03")], TRAFFIC_VIEW)
        upsert_batch(rows, cfg.table("total_traffic"), 0)
        for _ in range(120):
            if published(spark, out).count():
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert [(r.view, r.record_date, r.tile, r["rows"]) for r in published(spark, out).collect()] == [
        ("totalTraffic", "2024-01-03", "Route-37", 1)
    ]


def test_text_stream_results_per_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("hello big world\nhello\n")
    root = str(tmp_path / "out")
    lines = text_stream.text_lines(spark, str(source))
    text_stream.run_text_stream(spark, lines, root, available_now=True).awaitTermination()
    (source / "b.txt").write_text("one more\n")
    text_stream.run_text_stream(spark, lines, root, available_now=True).awaitTermination()

    def rows(name, batch):
        return [tuple(r) for r in spark.read.parquet(f"{root}/{name}/batch_id={batch}").collect()]

    assert sorted(rows("lengths", 0)) == [(5,), (15,)]
    assert rows("longest", 0) == [("hello",)] and rows("longest", 1) == [("more",)]
    assert sorted(rows("words_not_hello", 0)) == [("big",), ("world",)]
    assert rows("sorted", 0)[0] == (2, "hello")
    assert sorted(rows("counts", 1)) == [("more", 1), ("one", 1)]
    assert textops.words(spark.read.text(str(source))).count() == 6
