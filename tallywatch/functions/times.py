"""Event-time expressions. Sessions run in UTC."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units accepted in a length such as "5 minutes".
_UNITS = {
    "microsecond": timedelta(microseconds=1),
    "millisecond": timedelta(milliseconds=1),
    "second": timedelta(seconds=1),
    "minute": timedelta(minutes=1),
    "hour": timedelta(hours=1),
    "day": timedelta(days=1),
    "week": timedelta(weeks=1),
}


def micros_of(length: str) -> int:
    """Microseconds in a length such as ``"1 hour"``."""
    count, unit = length.split()
    return int(count) * (_UNITS[unit.rstrip("s")] // timedelta(microseconds=1))


def interval(length: str) -> Column:
    """An interval literal from a length such as ``"1 hour"``."""
    return F.expr(f"INTERVAL {length}")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ."""
    return F.unix_micros(ts.cast("timestamp"))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def parse_event_time(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; null where it cannot be read."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    """UTC time as ISO-8601 text with microseconds and offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def weekday_from_monday(ts: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_night(ts: Column) -> Column:
    """1 from 22:00 up to and including the hour of 05:00."""
    hour = F.hour(ts)
    return ((hour >= 22) | (hour <= 5)).cast("int")


def recent(ts: Column, as_of: Column, lookback: str) -> Column:
    """True for times not older than ``lookback`` before ``as_of``."""
    return ts >= as_of - interval(lookback)
