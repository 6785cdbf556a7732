"""Text-stream operators on a folder of text files.

Lengths, words and the filter are stateless.  Counts and the longest word are
per batch, as each batch of lines is a result of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators import textops

# Fixed value: length of the text stream's batches, in seconds.
BATCH_SECONDS = 30


def text_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of the files that arrive in a folder."""
    return spark.readStream.format("text").options(**options).load(path)


def run_text_stream(
    spark: SparkSession, lines: DataFrame, root: str, available_now: bool = False
) -> StreamingQuery:
    """Write the results of every batch to ``root/<result>/batch_id=N``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            words = textops.words(batch)
            counts = textops.count_by_value(words)
            results = {
                "lengths": textops.line_lengths(batch),
                "words": words,
                "words_not_hello": textops.words_except(words),
                "longest": textops.longest_word(words),
                "counts": textops.word_count(words),
                "sorted": textops.swap(textops.by_count_descending(counts)),
            }
            for name, rows in results.items():
                rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = lines.writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", f"{root}/checkpoints/text")
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{BATCH_SECONDS} seconds").start()
