"""Event time: weekdays, days, intervals and text formats."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of messages and record dates.  The fraction
# is optional, so whole seconds and microseconds both parse.
MESSAGE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
DATE_FORMAT = "yyyy-MM-dd"
# Milliseconds of the first and last instant of the years 1 to 9999.
EPOCH_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)


def iso_weekday(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1


def day_start(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def record_date(ts: Column) -> Column:
    return F.date_format(ts, DATE_FORMAT)


def event_time(as_of: datetime | str | Column | None = None) -> Column:
    """Processing time stamped on result rows: now, or a given instant."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def parse_event_time(text: Column, source_tz: str | None = None) -> Column:
    """Message time, written as text or as epoch milliseconds; null if neither.
    ``source_tz`` names the zone the sender formatted its clock in."""
    written = F.try_to_timestamp(text, F.lit(MESSAGE_TIME_FORMAT))
    if source_tz:
        written = F.to_utc_timestamp(written, source_tz)
    number = text.try_cast("bigint")
    first, last = EPOCH_MILLIS
    # converting a number outside the range of timestamps would end the job
    millis = F.when(number.between(first, last), F.timestamp_millis(number))
    return F.coalesce(written, millis)


def in_interval(ts: Column, start, end, bounds: str = "half_open") -> Column:
    """``[start, end)``, or ``(start, end)`` with ``bounds="open"``."""
    start, end = event_time(start), event_time(end)
    if bounds == "half_open":
        return (ts >= start) & (ts < end)
    if bounds == "open":
        return (ts > start) & (ts < end)
    raise ValueError(f"unknown bounds {bounds!r}: expected 'half_open' or 'open'")
