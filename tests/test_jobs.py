"""The batch job and the speed model."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from roadpulse.operators import heatmap, poi, speed, traffic
from roadpulse.plans.jobs import BatchConfig, run_batch, run_speed_model
from roadpulse.plans.stream_runs import topic_records
from roadpulse.sources import archive, codec
from roadpulse.sources.testdata import vehicle_events

AS_OF = "2024-02-01 00:00:00"
NEAR = poi.PointOfInterest(53.877495, -6.50238, 100.0, "Truck", "Route-37")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("job") / "archive")
    archive.write_archive(codec.decode(topic_records(spark, SMALL)), path)
    return path


def same(left, right):
    left, right = left.select(sorted(left.columns)), right.select(sorted(right.columns))
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


@pytest.mark.parametrize("include_last_day", [True, False])
def test_batch_job(spark, stored, tmp_path, include_last_day):
    cfg = BatchConfig(stored, str(tmp_path), NEAR, include_last_day=include_last_day, as_of=AS_OF)
    paths = run_batch(spark, cfg)
    paths = run_batch(spark, cfg)  # a second run replaces the views
    events = vehicle_events(spark, SMALL)
    same(spark.read.parquet(paths["total_traffic"]), traffic.total_traffic(events, AS_OF))
    daily = spark.read.parquet(paths["window_traffic"])
    same(
        daily.withColumn("record_date", F.col("record_date").cast("string")),
        traffic.daily_traffic(events, AS_OF, include_last_day),
    )
    same(
        spark.read.parquet(paths["heat_map"]).drop("record_date"),
        heatmap.heatmap_daily(events, include_last_day=include_last_day),
    )
    near = spark.read.parquet(paths["poi_traffic"])
    same(near, poi.latest_per_vehicle(poi.near_point(events, NEAR)))
    assert near.count() > 0


def test_batch_job_follows_its_archive(spark, tmp_path):
    """Days the archive no longer has are gone after the next run."""
    events = vehicle_events(spark, SMALL)
    full, part = str(tmp_path / "full"), str(tmp_path / "part")
    records = topic_records(spark, SMALL)
    archive.write_archive(codec.decode(records), full)
    early = F.col("timestamp") < "2024-01-10"
    archive.write_archive(codec.decode(records.filter(early)), part)
    for include_last_day in (True, False):
        for source, kept in ((full, events), (part, events.filter(F.col("ts") < "2024-01-10"))):
            cfg = BatchConfig(source, str(tmp_path / "out"), NEAR, as_of=AS_OF, include_last_day=include_last_day)
            paths = run_batch(spark, cfg)
            same(spark.read.parquet(paths["total_traffic"]), traffic.total_traffic(kept, AS_OF))
            daily = spark.read.parquet(paths["window_traffic"])
            same(
                daily.withColumn("record_date", F.col("record_date").cast("string")),
                traffic.daily_traffic(kept, AS_OF, include_last_day),
            )


def elastic_net(x, y, reg, alpha, rounds=2000):
    """Coordinate descent on standardised features and label, where the penalty
    is divided by the label's deviation."""
    mean, std = x.mean(0), x.std(0, ddof=1)
    y_std = y.std(ddof=1)
    z, centred = (x - mean) / std, y - y.mean()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        for j in range(len(w)):
            partial = centred - z @ w + z[:, j] * w[j]
            rho = z[:, j] @ partial / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - reg * alpha, 0) / (
                (z[:, j] ** 2).mean() + reg * (1 - alpha) / y_std
            )
    coefficients = w / std
    return coefficients, y.mean() - coefficients @ mean


@pytest.fixture(scope="module")
def drives(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        lat, lon, day = rng.uniform(52, 56), -rng.uniform(7, 11), rng.randrange(1, 8)
        label = 20 + 6 * int(lat) + 2 * int(lon) - 1.5 * day + rng.gauss(0, 2)
        rows.append((i, f"v{i % 9}", lat, lon, f"2024-01-{7 + day:02d} 10:00:00", label))
    made = spark.createDataFrame(
        rows, "event_id bigint, vehicle_id string, latitude double, longitude double, t string, speed double"
    )
    return made.withColumn("ts", F.col("t").cast("timestamp")).drop("t").cache()


def test_model_matches_coordinate_descent(spark, drives):
    fitted = speed.train(drives)
    rows = fitted.training.select("lat", "long", "dayOfWeek", "label").toPandas().to_numpy(float)
    coefficients, intercept = elastic_net(rows[:, :3], rows[:, 3], 0.3, 0.8)
    assert np.allclose(fitted.regression.coefficients.toArray(), coefficients, rtol=0.02)
    assert fitted.regression.intercept == pytest.approx(intercept, rel=0.02)

    report = speed.report(spark, fitted).first()
    fit = rows[:, :3] @ fitted.regression.coefficients.toArray() + fitted.regression.intercept
    assert report.training_rmse == pytest.approx(float(np.sqrt(((rows[:, 3] - fit) ** 2).mean())))
    assert report.test_r2 > 0.5 and len(report.objective_history) >= 1
    assert fitted.residuals().count() == len(rows)


def test_split_is_even_and_repeatable(drives):
    features = speed.speed_features(drives)
    training, test = speed.split(features)
    assert training.count() + test.count() == 600
    assert 430 < training.count() < 530
    again, _ = speed.split(speed.speed_features(drives.repartition(7)))
    assert {r.event_id for r in again.collect()} == {r.event_id for r in training.collect()}
    other, _ = speed.split(features, seed=12)
    assert {r.event_id for r in other.collect()} != {r.event_id for r in training.collect()}


def test_features_cut_toward_zero(spark):
    rows = spark.createDataFrame(
        [(1, "v", "53.12", "-7.9", "2024-01-07", 50.0)],
        "event_id bigint, vehicle_id string, latitude string, longitude string, ts string, speed double",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    row = speed.speed_features(rows).first()
    assert (row.lat, row.long, row.dayOfWeek, row.grid) == (53, -7, 7, "53.12|-7.9")


def test_speed_job_saves_and_scores(spark, stored, tmp_path):
    report, scored = run_speed_model(spark, stored, str(tmp_path / "model"))
    assert report.count() == 1
    assert scored.columns == ["features", "label", "prediction"]
    assert scored.count() > 100
    # saving again replaces the model
    run_speed_model(spark, stored, str(tmp_path / "model"))


def test_prediction_needs_three_features(spark, drives):
    from pyspark.ml.linalg import Vectors

    regression = speed.train(drives).regression
    with pytest.raises(Exception, match="size"):
        regression.predict(Vectors.dense(53.0, -7.0))
