"""Sliding-window counts over event time."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Panes are windowed in stretches of at least this many seconds, so that a key
# with much of the data is worked on by many tasks.
STRETCH_SECONDS = 3600
# A window of more panes than this is summed by copying panes into windows.
MAX_PANES = 48


def sliding_counts(events: DataFrame, keys: list[Column], window_seconds: int, slide_seconds: int) -> DataFrame:
    """Count per key and window: the key columns, ``window_start``,
    ``window_end``, ``total_count``.  Windows start at multiples of the slide;
    windows without events do not appear.

    A 120-second window sliding by 10 seconds holds every event twelve times.
    Events are therefore counted once, in panes that divide window and slide.
    Each window is then made by the first pane in it, which looks ahead to the
    panes behind it: every window comes out once and complete, without a second
    aggregation over twelve copies of the panes.
    """
    if slide_seconds > window_seconds:
        raise ValueError("the slide may not be longer than the window")
    pane = gcd(window_seconds, slide_seconds)
    seconds = F.unix_seconds("ts")
    panes = (
        events.filter(F.col("ts").isNotNull())
        .groupBy(*keys, (seconds - F.pmod(seconds, F.lit(pane))).alias("pane"))
        .agg(F.count("*").alias("n"))
    )
    names = [c for c in panes.columns if c not in ("pane", "n")]
    if window_seconds // pane > MAX_PANES:
        return _by_copies(panes, names, window_seconds, slide_seconds)
    return _by_first_pane(panes, names, window_seconds, slide_seconds, pane)


def _by_first_pane(panes: DataFrame, names: list[str], length: int, slide: int, pane: int) -> DataFrame:
    at, start = F.col("pane"), F.col("start")
    # a stretch also gets the panes within one window before and after it
    stretch = max(STRETCH_SECONDS, 2 * length)
    home = F.floor(at / stretch)
    inside = F.pmod(at, F.lit(stretch))
    stretches = F.array(
        home, F.when(inside < length, home - 1), F.when(inside >= stretch - length, home + 1)
    )
    placed = panes.select(*names, "pane", "n", F.explode(stretches).alias("stretch")).filter(
        F.col("stretch").isNotNull()
    )

    in_stretch = Window.partitionBy(*names, "stretch").orderBy("pane")
    ahead = range(1, length // pane)
    seen = placed.select(
        "*",
        F.lag("pane").over(in_stretch).alias("before"),
        *[F.lead("pane", i).over(in_stretch).alias(f"pane_{i}") for i in ahead],
        *[F.lead("n", i).over(in_stretch).alias(f"n_{i}") for i in ahead],
    ).filter(F.col("stretch") == home)

    # starts of the windows this pane is in and the pane before it is not
    earliest = F.greatest(at - length + pane, F.col("before") + pane)
    first = earliest + F.pmod(-earliest, F.lit(slide))
    last = at - F.pmod(at, F.lit(slide))
    starts = seen.filter(first <= last).withColumn(
        "start", F.explode(F.sequence(first, last, F.lit(slide).cast("bigint")))
    )
    total = F.col("n")
    for i in ahead:
        total = total + F.when(F.col(f"pane_{i}") < start + length, F.col(f"n_{i}")).otherwise(0)
    return starts.select(
        *names,
        F.timestamp_seconds(start).alias("window_start"),
        F.timestamp_seconds(start + length).alias("window_end"),
        total.alias("total_count"),
    )


def _by_copies(panes: DataFrame, names: list[str], length: int, slide: int) -> DataFrame:
    spread = panes.select(*names, F.timestamp_seconds("pane").alias("at"), "n")
    window = F.window("at", f"{length} seconds", f"{slide} seconds").alias("window")
    return flat_window(spread.groupBy(*names, window).agg(F.sum("n").alias("total_count")), names)


def sliding_counts_stream(
    events: DataFrame, keys: list[Column], window_seconds: int, slide_seconds: int
) -> DataFrame:
    """The same on a stream with a watermark.  Spark keeps the window sums in
    its state store and updates them, so nothing is recomputed per slide."""
    window = F.window("ts", f"{window_seconds} seconds", f"{slide_seconds} seconds").alias("window")
    counts = events.groupBy(*keys, window).agg(F.count("*").alias("total_count"))
    names = [c for c in counts.columns if c not in ("window", "total_count")]
    return flat_window(counts, names)


def flat_window(counts: DataFrame, names: list[str]) -> DataFrame:
    return counts.select(
        *names,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total_count",
    )


def newest_window(view: DataFrame) -> DataFrame:
    """Rows of the latest window; the one-row side is the join's small side."""
    return view.join(view.agg(F.max("window_start").alias("window_start")), "window_start").select(
        view.columns
    )
