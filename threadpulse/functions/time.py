"""Event-time expressions. All assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(epoch_seconds: str | Column) -> Column:
    return F.timestamp_seconds(epoch_seconds)


def hour_slot(ts: str | Column) -> Column:
    """Two-hour slot of the day, 1 to 12."""
    return F.shiftright(F.hour(ts), 1) + 1


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(ts)


def weekday(ts: str | Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(ts) - 1


def window_label(ts: str | Column) -> Column:
    """Readable form of a window start, e.g. ``Mon Jan 01 00:00:00 UTC 2018``."""
    return F.date_format(ts, "EEE MMM dd HH:mm:ss 'UTC' yyyy")


def processing_time() -> Column:
    """Wall-clock time of the batch that produced a row, for audits."""
    return F.current_timestamp()
