"""Tumbling event-time windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: origin of the slot report windows, 2017-12-31 23:00 UTC.
SLOT_ORIGIN_MS = 1514761200000


@dataclass(frozen=True)
class Span:
    """A window length in hours; ``origin_ms`` shifts the grid away from the epoch."""

    hours: int
    origin_ms: int = 0

    @property
    def length_ms(self) -> int:
        return self.hours * 3_600_000

    def column(self, ts: str | Column = "ts") -> Column:
        length = f"{self.hours} hours"
        shift = self.origin_ms % self.length_ms
        if not shift:
            return F.window(ts, length)
        return F.window(ts, length, length, f"{shift} milliseconds")


# Aligned to the epoch: weeks start on Thursday, "months" are 30-day blocks.
HOUR = Span(1)
DAY = Span(24)
WEEK = Span(7 * 24)
MONTH = Span(30 * 24)

# Aligned to the slot origin; this month has 31 days.
ORIGIN_DAY = Span(24, SLOT_ORIGIN_MS)
ORIGIN_WEEK = Span(7 * 24, SLOT_ORIGIN_MS)
ORIGIN_MONTH = Span(31 * 24, SLOT_ORIGIN_MS)


def assign_window(df: DataFrame, span: Span, ts: str = "ts") -> DataFrame:
    return df.withColumn("window", span.column(ts))


def regroup_window(df: DataFrame, span: Span) -> DataFrame:
    """Put the rows of a windowed aggregate back into windows of the same grid.

    Works on a stream too: ``window_time`` keeps the watermark of the first aggregate.
    """
    return df.withColumn("window", span.column(F.window_time("window")))


def label_window(df: DataFrame) -> DataFrame:
    """Replace the window struct by its start in epoch milliseconds, first column."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.unix_millis("window.start").alias("win_start_ms"), *rest)


def closed_only(df: DataFrame, span: Span, newest_ms: Column | int) -> DataFrame:
    """Windows that end at or before ``newest_ms``: what a stream would have emitted."""
    return df.where(F.col("win_start_ms") + F.lit(span.length_ms) <= newest_ms)
