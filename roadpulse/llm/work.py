"""Helpers the operators share: written intermediate tables and Arrow rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import workspace

ARROW_BATCH_BYTES = "4m"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared work folder and read it back: later stages
    start from files any executor can read, so a lost one costs its tasks only."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of one Arrow batch, for tables with very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` alone: further columns can't clash with ours."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def whole_rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns, whatever their names), ``doc_id``, ``text``, ``text_hash``."""
    return texts(docs, F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_hash(docs))


def text_hash(docs: DataFrame) -> Column:
    """With the id it tells documents apart; rows equal in both are alike."""
    return F.xxhash64(docs["text"].cast("string")).alias("text_hash")


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]], schema: str
) -> DataFrame:
    """``mapInArrow`` with state per task: ``make`` runs once in a task, what it
    returns turns a batch into column dictionaries.  If that has an attribute
    ``finish``, its columns follow the last batch (sums kept over the task)."""
    small_batches(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        step = make()

        def rows(columns):
            arrays = [
                c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type, from_pandas=False)
                for f in arrow
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            yield from map(rows, step(batch))
        if hasattr(step, "finish"):
            yield from map(rows, step.finish())

    return df.mapInArrow(run, schema)


def packed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, size, packed``: texts compressed for a shuffle.

    A document is told apart by id and text hash, so rows that share an id but
    not the text stay apart, and rows equal in both get equal results."""

    def make():
        codec = pa.Codec("zstd", compression_level=3)

        def step(batch):
            data = [t.as_buffer() if t.is_valid else pa.py_buffer(b"") for t in batch.column("text").cast(pa.large_binary())]
            yield {
                "doc_id": batch.column("doc_id"),
                "text_hash": batch.column("text_hash"),
                "size": [d.size for d in data],
                "packed": [codec.compress(d, asbytes=True) for d in data],
            }

        return step

    return map_batches(docs, make, "doc_id long, text_hash long, size long, packed binary")


def unpacked(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch with columns ``packed`` and ``size``."""
    codec = pa.Codec("zstd")
    data = [
        codec.decompress(z.as_buffer(), decompressed_size=n.as_py(), asbytes=True) if n.as_py() else b""
        for z, n in zip(batch.column("packed"), batch.column("size"))
    ]
    return pa.array(data, type=pa.large_binary()).cast(pa.large_string())
