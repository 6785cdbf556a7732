"""Delimited event rows: day, vehicle, type, route, latitude, longitude, speed, fuel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.times import DATE_FORMAT
from roadpulse.schemas import DELIMITED_EVENT, VEHICLE_EVENT


def read_delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Read event rows; a row that does not parse fails the job."""
    rows = (
        spark.read.schema(DELIMITED_EVENT)
        .option("sep", sep)
        .option("dateFormat", DATE_FORMAT)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).select(
        [f.name for f in VEHICLE_EVENT.fields]
    )


def write_delimited(events: DataFrame, path: str, sep: str = ",") -> None:
    columns = [f.name for f in DELIMITED_EVENT.fields]
    days = events.withColumn("ts", F.to_date("ts")).select(columns)
    days.write.option("sep", sep).option("dateFormat", DATE_FORMAT).csv(path)
