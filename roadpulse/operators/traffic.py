"""Traffic counts by route and vehicle type."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.times import event_time, in_interval, record_date
from roadpulse.operators.windows import sliding_counts, sliding_counts_stream
from roadpulse.schemas import TRAFFIC_VIEW

KEYS = ["route_id", "vehicle_type"]
# Length and slide of the live traffic window, in seconds.
WINDOW_SECONDS = 30
SLIDE_SECONDS = 10

AsOf = datetime | str | None


def total_traffic(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Events per route and type over the whole input."""
    counts = events.groupBy(*KEYS).agg(F.count("*").alias("total_count"))
    now = event_time(as_of)
    return _view(counts.withColumns({"time_stamp": now, "record_date": record_date(now)}))


def total_of_daily(daily: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The same from the daily view, so a job that has both scans events once."""
    counts = daily.groupBy(*KEYS).agg(F.sum("total_count").alias("total_count"))
    now = event_time(as_of)
    return _view(counts.withColumns({"time_stamp": now, "record_date": record_date(now)}))


def daily_traffic(events: DataFrame, as_of: AsOf = None, include_last_day: bool = True) -> DataFrame:
    """Events per event day, route and type, in one aggregation.

    ``include_last_day=False`` keeps only the days that are complete by the
    rule of ``complete_days``.
    """
    if not include_last_day:
        events = on_complete_days(events)
    # events without a time belong to no day; the date is formatted once per
    # result row instead of once per event
    dated = events.filter(F.col("ts").isNotNull())
    counts = dated.groupBy(*KEYS, F.to_date("ts").alias("day")).agg(F.count("*").alias("total_count"))
    return _view(
        counts.withColumns({"time_stamp": event_time(as_of), "record_date": record_date(F.col("day"))})
    )


def window_traffic(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Events per route and type in 30-second windows every 10 seconds."""
    keys = [F.col(k) for k in KEYS]
    return window_rows(sliding_counts(events, keys, WINDOW_SECONDS, SLIDE_SECONDS), as_of)


def window_traffic_stream(events: DataFrame) -> DataFrame:
    keys = [F.col(k) for k in KEYS]
    return sliding_counts_stream(events, keys, WINDOW_SECONDS, SLIDE_SECONDS)


def window_rows(counts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """View rows of window counts; they belong to the day their window opens."""
    return counts.withColumns(
        {"time_stamp": event_time(as_of), "record_date": record_date(F.col("window_start"))}
    ).select(*[f.name for f in TRAFFIC_VIEW.fields], "window_start", "window_end")


def event_time_span(events: DataFrame) -> DataFrame:
    """First and last event time and the whole days between them; one row."""
    span = events.agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))
    millis = F.abs(F.unix_millis("max_ts") - F.unix_millis("min_ts"))
    return span.withColumn("span_days", F.floor(millis / F.lit(86_400_000)).cast("bigint"))


def complete_days(events: DataFrame) -> tuple[date, date] | None:
    """``[first day, end day)``: as many days from the first event's day on as
    whole days lie between first and last event.  Brings one row to the driver."""
    span = event_time_span(events).select(F.to_date("min_ts").alias("first_day"), "span_days").first()
    if span.first_day is None:
        return None
    return span.first_day, span.first_day + timedelta(days=span.span_days)


def on_complete_days(events: DataFrame) -> DataFrame:
    days = complete_days(events)
    if days is None:
        return events.limit(0)
    # literal bounds, so the filter reaches the scan
    return events.filter(in_interval(F.col("ts"), str(days[0]), str(days[1])))


def _view(rows: DataFrame) -> DataFrame:
    return rows.select([f.name for f in TRAFFIC_VIEW.fields])
