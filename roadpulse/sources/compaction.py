"""Few large files for the archive's finished days.

The archiving stream adds files with every batch, and a file sink's folder must
not be rewritten under it.  So finished folders are rewritten into a table of
their own, as one Spark job, and the archive itself stays as it is.  A reader
takes a folder from there only while it holds as many rows as the archive's: a
folder that has got late rows since is read from the archive until the next
run, which rewrites it.  The archive only grows, so equal counts mean equal rows.
Counts come from file footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import ARCHIVE, ARCHIVE_PARTITIONS
from roadpulse.sources.archive import read_archive
from roadpulse.sources.footers import folder_aggregates, footers_only
from roadpulse.sources.viewstore import path_exists

_COUNTS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ARCHIVE.fields if f.name in ARCHIVE_PARTITIONS)


def folder_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per folder: one small row for each topic partition and day."""
    schema = f"{_COUNTS}, n bigint"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    with footers_only(spark):
        rows = folder_aggregates(spark, path, F.count(F.lit(1)).alias("n")).collect()
    return spark.createDataFrame(rows, schema)


def _same_folder(left: DataFrame, right: DataFrame):
    return [left[c].eqNullSafe(right[c]) for c in ARCHIVE_PARTITIONS]


def compact(spark: SparkSession, archive: str, compacted: str, before: str) -> int:
    """Rewrite the folders of days before ``before`` whose rows differ in number
    from the compacted ones; returns how many.  Dead letters without a day stay
    in the archive.  A run cut off in between leaves each folder old or new."""
    there = folder_counts(spark, archive).filter(F.col("event_date") < F.lit(before).cast("date"))
    here = folder_counts(spark, compacted)
    stale = there.join(here, [*_same_folder(there, here), there["n"] == here["n"]], "left_anti")
    number = stale.count()
    if number:
        rows = read_archive(spark, archive)
        wanted = rows.join(F.broadcast(stale), _same_folder(rows, stale), "left_semi")
        (
            wanted.hint("rebalance", *[F.col(c) for c in ARCHIVE_PARTITIONS])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*ARCHIVE_PARTITIONS)
            .parquet(compacted)
        )
    return number


def read_compacted(spark: SparkSession, archive: str, compacted: str) -> DataFrame:
    """The archive's rows, each folder from the compacted table where it is
    complete there.  Folders are dropped before they are read (dynamic
    partition pruning; the list of folders is broadcast)."""
    rows = read_archive(spark, archive)
    there, here = folder_counts(spark, archive), folder_counts(spark, compacted)
    complete = here.join(there, [*_same_folder(here, there), here["n"] == there["n"]], "left_semi")
    if not complete.take(1):
        return rows
    loose = there.join(complete, _same_folder(there, complete), "left_anti")
    packed = read_archive(spark, compacted)
    return rows.join(F.broadcast(loose), _same_folder(rows, loose), "left_semi").unionByName(
        packed.join(F.broadcast(complete), _same_folder(packed, complete), "left_semi")
    )
