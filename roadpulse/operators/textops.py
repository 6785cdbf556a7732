"""Operators of the text stream.  Each takes a DataFrame with ``value`` (lines)
or ``word`` (words) and works on batch input; those without an ordering work on
streams as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.words import split_lines, split_words


def lines(texts: DataFrame, column: str = "value") -> DataFrame:
    """One row per line of multi-line texts."""
    return texts.select(F.explode(split_lines(F.col(column))).alias("value"))


def line_lengths(line_rows: DataFrame) -> DataFrame:
    return line_rows.select(F.length("value").alias("length"))


def words(line_rows: DataFrame) -> DataFrame:
    return line_rows.select(F.explode(split_words(F.col("value"))).alias("word"))


def words_except(word_rows: DataFrame, unwanted: str = "hello") -> DataFrame:
    return word_rows.filter(F.col("word") != unwanted)


def longest_word(word_rows: DataFrame) -> DataFrame:
    """The longest word; the alphabetically first of several.  A global
    aggregate: each task sends one row."""
    best = F.min(F.struct((-F.length("word")).alias("rank"), F.col("word").alias("word")))
    return word_rows.agg(best.alias("best")).select(F.col("best.word").alias("word"))


def word_count(word_rows: DataFrame) -> DataFrame:
    """Pairs (word, 1) summed by word."""
    return word_rows.select("word", F.lit(1).cast("bigint").alias("one")).groupBy("word").agg(
        F.sum("one").alias("count")
    )


def count_by_value(word_rows: DataFrame) -> DataFrame:
    return word_rows.groupBy("word").count()


def swap(counts: DataFrame) -> DataFrame:
    """(word, count) to (count, word)."""
    return counts.select("count", "word")


def by_count_descending(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("count"), "word")


def top_words(counts: DataFrame, k: int = 10) -> DataFrame:
    """First rows of the order; Spark keeps k rows per task."""
    return by_count_descending(counts).limit(k)
