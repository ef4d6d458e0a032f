"""Coarser windows as sums of a table per day.

Day, week and 30-day windows share a grid, and so do the slot reports at their origin, so counts and scores of the
coarser ones are sums of day rows. The table of day rows is kept by day: when comments of some days arrive or
change, those days are computed again and replaced, and every coarser window is read from the table. Its size is
that of the result per day, not of the comments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from threadpulse.operators.windows import DAY, Span
from threadpulse.sources.days import read_days, write_days

#: Day windows of a grid: comments -> win_start_ms, keys and sums.
Daily = Callable[[DataFrame, Span], DataFrame]


def day_span(span: Span) -> Span:
    """The day grid that the windows of span consist of."""
    if span.hours % DAY.hours:
        raise ValueError(f"windows of {span.hours} hours do not consist of days")
    return Span(DAY.hours, span.origin_ms)


def coarser(days: DataFrame, span: Span, keys: Iterable[str], sums: Iterable[str]) -> DataFrame:
    """Sums of day rows (win_start_ms, keys, sums) per window of span; one exchange of day rows."""
    start = span.column(F.timestamp_millis("win_start_ms"))
    windowed = days.withColumn("win_start_ms", F.unix_millis(start.getField("start")))
    return windowed.groupBy("win_start_ms", *keys).agg(*(F.sum(c).alias(c) for c in sums))


class DayTable:
    """Day rows of one report below a path."""

    def __init__(
        self, spark: SparkSession, path: str, daily: Daily, span: Span, keys: Iterable[str], sums: Iterable[str]
    ) -> None:
        self.spark, self.path, self.daily, self.day = spark, path, daily, day_span(span)
        self.keys, self.sums = list(keys), list(sums)
        self.schema: StructType | None = None

    def update(self, comments: DataFrame) -> None:
        """Compute the days of these comments and replace them; each day must come whole."""
        rows = self.daily(comments, self.day).select("win_start_ms", *self.keys, *self.sums)
        self.schema = rows.schema
        write_days(rows, self.path, F.timestamp_millis("win_start_ms"))

    def rows(self) -> DataFrame:
        schema = self.schema or StructType([f for f in self.spark.read.parquet(self.path).schema if f.name != "day"])
        return read_days(self.spark, self.path, schema)

    def report(self, span: Span) -> DataFrame:
        """The report for windows of span, from day rows alone."""
        if day_span(span) != self.day:
            raise ValueError("these windows lie on another grid")
        return coarser(self.rows(), span, self.keys, self.sums)
