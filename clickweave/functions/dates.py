"""Dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of times and keys.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
DAY_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"


def parse_time(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` to a time; the hour may have one digit, bad text gives null."""
    return text.try_cast("timestamp_ntz")


def format_time(time: Column) -> Column:
    return F.date_format(time, TIME_FORMAT)


def format_date(time: Column) -> Column:
    return F.date_format(time, DATE_FORMAT)


def date_hour_key(time: Column) -> Column:
    """`yyyy-MM-dd_HH`, for display; group by `to_date` and `hour` instead."""
    return F.date_format(time, DATE_HOUR_FORMAT)


def from_epoch_ms(milliseconds: Column) -> Column:
    return F.timestamp_millis(milliseconds)


def day_key(time: Column) -> Column:
    """`yyyyMMdd` in the session time zone."""
    return F.date_format(time, DAY_KEY_FORMAT)


def minute_key(time: Column) -> Column:
    """`yyyyMMddHHmm` in the session time zone."""
    return F.date_format(time, MINUTE_KEY_FORMAT)


def parse_day_key(text: Column) -> Column:
    """`yyyyMMdd` to a date; bad text gives null."""
    return F.try_to_date(text, DAY_KEY_FORMAT)


def is_before(first: Column, second: Column) -> Column:
    return first < second


def is_after(first: Column, second: Column) -> Column:
    return first > second


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", start, end)


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)
