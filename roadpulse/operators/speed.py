"""Linear regression of speed on position and weekday.

``train`` is the Spark ML pipeline, which passes over the training rows in every
iteration.  ``fit_moments`` finds the same model from one pass: the objective
depends on the rows only through their means and covariances, which are
built-in aggregates, and coordinate descent on those few numbers needs no rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.times import iso_weekday
from roadpulse.operators.sightings import event_order

FEATURES = ["lat", "long", "dayOfWeek"]
# The regression's settings, the share of training rows and the
# seed of the split.
MAX_ITER = 10
REG_PARAM = 0.3
ELASTIC_NET_PARAM = 0.8
TRAINING_SHARE = 0.8
SEED = 11
# So small that the iterations end at the optimum and not on the way to it.
TOLERANCE = 1e-14


def speed_features(events: DataFrame) -> DataFrame:
    """``label``, the grid key and the three features; coordinates are cut to
    whole degrees toward zero.  Columns that identify the event stay."""
    lat, lon = F.col("latitude"), F.col("longitude")
    weekday = F.col("day_of_week") if "day_of_week" in events.columns else iso_weekday(F.col("ts"))
    return events.select(
        *event_order(events),
        "vehicle_id",
        F.col("speed").alias("label"),
        F.concat(lat.cast("string"), F.lit("|"), lon.cast("string")).alias("grid"),
        lat.cast("double").cast("int").alias("lat"),
        lon.cast("double").cast("int").alias("long"),
        weekday.cast("int").alias("dayOfWeek"),
    )


def split(features: DataFrame, training_share: float = TRAINING_SHARE, seed: int = SEED):
    """Training and test rows.  A hash of the event decides, so the split stays
    the same whatever the partitioning, and in reruns of lost tasks.  It is the
    first 32 bits of the MD5 of seed and keys (times in microseconds), joined by
    ``|``, which any other engine can compute as well."""
    keys = [c for c in ("vehicle_id", *event_order(features)) if c in features.columns]
    text = [F.unix_micros(c) if c == "ts" else F.col(c) for c in keys]
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[c.cast("string") for c in text]).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1_000_000
    limit = int(training_share * 1_000_000)
    return features.filter(draw < limit), features.filter(draw >= limit)


def speed_pipeline() -> Pipeline:
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    regression = LinearRegression(
        maxIter=MAX_ITER, regParam=REG_PARAM, elasticNetParam=ELASTIC_NET_PARAM, tol=TOLERANCE
    )
    return Pipeline(stages=[assembler, regression])


@dataclass
class SpeedModel:
    model: PipelineModel
    training: DataFrame
    test: DataFrame

    @property
    def regression(self) -> LinearRegressionModel:
        return self.model.stages[-1]

    def predictions(self, rows: DataFrame | None = None) -> DataFrame:
        """Features, label and prediction, for the test rows or given ones."""
        scored = self.model.transform(self.test if rows is None else rows)
        return scored.select([c for c in ("features", "label", "prediction") if c in scored.columns])

    def residuals(self) -> DataFrame:
        return self.regression.summary.residuals

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def train(events: DataFrame, training_share: float = TRAINING_SHARE, seed: int = SEED) -> SpeedModel:
    training, test = split(speed_features(events), training_share, seed)
    return SpeedModel(speed_pipeline().fit(training), training, test)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def report(spark: SparkSession, fitted: SpeedModel) -> DataFrame:
    """One row: coefficients, iterations and the errors on both parts."""
    lr = fitted.regression
    summary = lr.summary
    assembled = fitted.model.stages[0].transform(fitted.test)
    test = lr.evaluate(assembled)
    row = (
        *[float(c) for c in lr.coefficients],
        float(lr.intercept),
        int(summary.totalIterations),
        [float(x) for x in summary.objectiveHistory],
        float(summary.rootMeanSquaredError),
        float(summary.r2),
        float(test.rootMeanSquaredError),
        float(test.r2),
    )
    names = "lat_coefficient double, long_coefficient double, day_coefficient double, "
    names += "intercept double, iterations int, objective_history array<double>, "
    names += "training_rmse double, training_r2 double, test_rmse double, test_r2 double"
    return spark.createDataFrame([row], names)


@dataclass(frozen=True)
class MomentModel:
    coefficients: tuple[float, ...]
    intercept: float

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with ``features`` and ``prediction``."""
        known = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        terms = [F.lit(c) * F.col(name) for c, name in zip(self.coefficients, FEATURES)]
        return known.withColumn("prediction", sum(terms, F.lit(self.intercept)))


def moments(training: DataFrame) -> DataFrame:
    """One row: means and covariances of features and label."""
    names = [*FEATURES, "label"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return training.agg(
        *[F.avg(a).alias(f"mean_{a}") for a in names],
        *[F.covar_pop(a, b).alias(f"{a}_{b}") for a, b in pairs],
    )


def descend(inner: list[list[float]], outer: list[float], l1: float, l2: float) -> list[float]:
    """Coefficients that minimise b'Ab/2 - b'c + l1 |b| + l2 |b|^2 / 2, one after
    the other in turn until none changes.  ``inner`` is A, ``outer`` is c."""
    beta = [0.0] * len(outer)
    for _ in range(10_000):
        before = list(beta)
        for j, row in enumerate(inner):
            rest = outer[j] - sum(row[k] * beta[k] for k in range(len(beta)) if k != j)
            pull = max(abs(rest) - l1, 0.0)
            beta[j] = (pull if rest > 0 else -pull) / (row[j] + l2) if row[j] + l2 else 0.0
        if max(abs(a - b) for a, b in zip(beta, before)) < 1e-14:
            break
    return beta


def fit_moments(
    training: DataFrame, reg: float = REG_PARAM, elastic_net: float = ELASTIC_NET_PARAM
) -> MomentModel:
    """The elastic net on features and label scaled by their deviations.  A
    feature that never varies gets 0; so do all if the label never varies."""
    m = moments(training).first().asDict()
    names = [*FEATURES, "label"]
    if not m["label_label"]:
        return MomentModel((0.0,) * len(FEATURES), m["mean_label"] or 0.0)
    spread = {a: m[f"{a}_{a}"] ** 0.5 or 1.0 for a in names}

    def scaled(a: str, b: str) -> float:
        a, b = sorted((a, b), key=names.index)
        return m[f"{a}_{b}"] / spread[a] / spread[b]

    inner = [[scaled(a, b) for b in FEATURES] for a in FEATURES]
    strength = reg / spread["label"]
    beta = descend(inner, [scaled(a, "label") for a in FEATURES], strength * elastic_net, strength * (1 - elastic_net))
    own = tuple(b * spread["label"] / spread[a] for a, b in zip(FEATURES, beta))
    return MomentModel(own, m["mean_label"] - sum(c * m[f"mean_{a}"] for a, c in zip(FEATURES, own)))


def errors(part: str) -> list[Column]:
    """Root mean squared error and r2 of the rows of one part, as aggregates."""
    mine = F.when(F.col("part") == part, F.col("label"))
    missed = F.sum(F.pow(mine - F.col("prediction"), 2))
    return [
        F.sqrt(missed / F.count(mine)).alias(f"{part}_rmse"),
        (1 - missed / (F.count(mine) * F.var_pop(mine))).alias(f"{part}_r2"),
    ]


def moment_report(events: DataFrame, reg: float = REG_PARAM, elastic_net: float = ELASTIC_NET_PARAM) -> DataFrame:
    """One row: coefficients, intercept and the errors on both parts."""
    training, test = split(speed_features(events))
    model = fit_moments(training, reg, elastic_net)
    names = ["lat_coefficient", "long_coefficient", "day_coefficient"]
    row = [F.lit(c).alias(name) for c, name in zip(model.coefficients, names)]
    scored = model.transform(training.withColumn("part", F.lit("training")).unionByName(test.withColumn("part", F.lit("test"))))
    both = scored.agg(*[e for part in ("training", "test") for e in errors(part)])
    return both.select(*row, F.lit(model.intercept).alias("intercept"), *both.columns)
