"""Event time. Text without a zone is wall clock in the session zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column | str) -> Column:
    """TIMESTAMP from ISO-8601 text; unreadable text gives null, never an error."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def event_time_ntz(text: Column | str) -> Column:
    """TIMESTAMP_NTZ from ISO-8601 text: the wall clock as written, any offset ignored."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("timestamp_ntz")


def event_date(ts: Column | str) -> Column:
    return F.to_date(ts)


def plus_millis(ts: Column, millis: Column) -> Column:
    """`ts` moved by a whole number of milliseconds."""
    return F.timestamp_micros(F.unix_micros(ts) + millis.cast("bigint") * 1000)
