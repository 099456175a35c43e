"""Clock and epoch columns. The clock is a parameter, so a job can be run for a past moment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def now(clock: str | None = None) -> Column:
    """The given moment, or the time the query (or micro-batch) started."""
    return F.current_timestamp() if clock is None else F.lit(clock).cast("timestamp")


def day_text(at: Column) -> Column:
    return F.substring(at.cast("string"), 1, 10)


def today(clock: str | None = None) -> Column:
    return day_text(now(clock))


def is_today(text: Column, clock: str | None = None) -> Column:
    """Day prefix of a text equals today's. Compared as text: a malformed value is just not
    today, where a cast to date would fail the query."""
    return F.substring(text, 1, 10) == today(clock)


def millis_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def timestamp_to_millis(at: Column) -> Column:
    return F.unix_millis(at.cast("timestamp"))
