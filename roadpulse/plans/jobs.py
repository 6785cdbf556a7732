"""The batch job, the speed-model job and the dashboard snapshot."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators import heatmap, poi, serving, speed, traffic
from roadpulse.operators.windows import newest_window
from roadpulse.schemas import TRAFFIC_VIEW
from roadpulse.session import prepare
from roadpulse.sources.archive import read_archive
from roadpulse.sources.codec import good
from roadpulse.sources.viewstore import read_changes, read_if_exists, write_view
from roadpulse.streaming.pipeline import LiveConfig, live_view

# Fixed value: seconds between two snapshots.
SNAPSHOT_SECONDS = 15


@dataclass
class BatchConfig:
    archive: str
    output: str
    poi: poi.PointOfInterest = poi.BATCH_POI
    grid: str = "box"
    bounds: str = "half_open"
    include_last_day: bool = True
    as_of: str | None = None

    def table(self, name: str) -> str:
        return f"{self.output}/{name}"


def run_batch(spark: SparkSession, cfg: BatchConfig) -> dict[str, str]:
    """Recompute the four batch views from the archive; returns their paths.
    A view replaces its earlier table whole: days the archive no longer has go.

    Three scans, each of the columns it needs only: the totals are summed from
    the daily view that was just written.  Totals cover every event, so with
    ``include_last_day=False`` they cannot come from the shortened daily view
    and are counted from the archive.
    """
    prepare(spark)
    events = good(read_archive(spark, cfg.archive))
    paths = {
        name: cfg.table(f"{name}_batch")
        for name in ("heat_map", "poi_traffic", "total_traffic", "window_traffic")
    }

    heat = heatmap.heatmap_daily(events, cfg.grid, cfg.bounds, cfg.include_last_day)
    write_view(
        heat.withColumn("record_date", heat["time_stamp"].cast("date")),
        paths["heat_map"],
        ["record_date"],
        whole=True,
    )

    near = poi.near_point(events, cfg.poi)
    write_view(poi.latest_per_vehicle(near), paths["poi_traffic"])

    daily = traffic.daily_traffic(events, cfg.as_of, cfg.include_last_day)
    write_view(daily, paths["window_traffic"], ["record_date"], whole=True)

    if cfg.include_last_day:
        written = spark.read.parquet(paths["window_traffic"])
        totals = traffic.total_of_daily(written, cfg.as_of)
    else:
        totals = traffic.total_traffic(events, cfg.as_of)
    write_view(totals, paths["total_traffic"])
    return paths


def run_speed_model(
    spark: SparkSession, archive: str, model_path: str
) -> tuple[DataFrame, DataFrame]:
    """Train on the archive, save the model, load it again and score the test
    rows with it: the report row and the predictions."""
    prepare(spark)
    fitted = speed.train(good(read_archive(spark, archive)))
    metrics = speed.report(spark, fitted)
    fitted.save(model_path)
    scored = speed.load(model_path).transform(fitted.test)
    return metrics, scored.select("features", "label", "prediction")


def start_snapshots(
    spark: SparkSession,
    cfg: LiveConfig,
    path: str,
    as_of: str | None = None,
    every_seconds: int = SNAPSHOT_SECONDS,
) -> StreamingQuery:
    """Publish what has changed every 15 seconds.  With ``available_now`` there is
    no clock: a snapshot is published if the totals have changed since the last
    run."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        publish_changes(spark, cfg, path, batch_id, as_of)

    if cfg.available_now:
        changes = spark.readStream.schema(TRAFFIC_VIEW).parquet(f"{cfg.table('total_traffic')}/log")
        writer = changes.writeStream.foreachBatch(publish)
        writer = writer.option("checkpointLocation", cfg.checkpoint("snapshots"))
        return writer.trigger(availableNow=True).start()
    # one row a second: no batch is empty, so each trigger fires
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = clock.writeStream.foreachBatch(publish)
    writer = writer.option("checkpointLocation", cfg.checkpoint("snapshot_clock"))
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()


def published(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Documents published so far, with ``upto`` (the view's batch they stand for)
    and ``snapshot``; with ``before`` those of earlier snapshots only."""
    schema = f"{serving.DOCUMENT}, upto bigint, snapshot int"
    rows = read_if_exists(spark, path, schema)
    if rows is None:
        return spark.createDataFrame([], schema)
    return rows if before is None else rows.filter(F.col("snapshot") < before)


def publish_changes(spark: SparkSession, cfg: LiveConfig, path: str, number: int, as_of: str | None = None) -> None:
    """Write the documents of the live views that differ from what snapshots
    before ``number`` published; a repeated number overwrites itself.

    A view's change log tells which tiles were written to since: rows of later
    batches than the last published one.  Views no batch has been written to
    yet are left out."""
    earlier = published(spark, path, number)
    before = serving.current_documents(earlier)
    seen = {r["view"]: r["upto"] for r in earlier.groupBy("view").agg(F.max("upto").alias("upto")).collect()}
    parts = []
    for view, tiling in serving.TILINGS.items():
        try:
            changes = read_changes(spark, cfg.table(view))
        except FileNotFoundError:
            continue
        # one number
        newest = changes.agg(F.max("batch_id").cast("bigint")).first()[0]
        touched = changes.filter(F.col("batch_id") > seen.get(tiling.name, -1))
        rows = live_view(spark, cfg, view, as_of)
        parts.append(serving.changed_documents(rows, touched, before, tiling).withColumn("upto", F.lit(newest)))
    if not parts:
        return
    changed = reduce(DataFrame.unionByName, parts).persist()
    try:
        if not changed.isEmpty():
            changed.write.mode("overwrite").parquet(f"{path}/snapshot={number}")
    finally:
        changed.unpersist()


def live_snapshot(spark: SparkSession, cfg: LiveConfig, day: str | None = None, as_of: str | None = None) -> DataFrame:
    """The four live views as JSON documents by date and tile: totals, and the
    newest window, of one day or all, the other two as they stand.  A view that
    no batch has been written to yet has no document."""

    def of_day(rows: DataFrame) -> DataFrame:
        return rows if day is None else serving.by_date(rows, day)

    views = {}
    for view, tiling in serving.TILINGS.items():
        try:
            if view == "window_traffic":
                rows = newest_window(of_day(live_view(spark, cfg, view, newest_only=False)))
            else:
                rows = live_view(spark, cfg, view, as_of)
                rows = of_day(rows) if view == "total_traffic" else rows
        except FileNotFoundError:
            continue
        views[view] = (rows, tiling)
    return serving.snapshot(views) if views else spark.createDataFrame([], serving.DOCUMENT)
