"""Top-k per window and the text form of a ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadpulse.functions.time import window_label


def top_k(df: DataFrame, k: int, value: str, key: str) -> DataFrame:
    """The k largest values per ``win_start_ms``; equal values rank by ascending key.

    Spark limits each task's share of a window to k rows before the exchange, so
    a window never moves whole to one task.
    """
    order = Window.partitionBy("win_start_ms").orderBy(F.desc(value), F.asc(key))
    return (
        df.withColumn("rk", F.row_number().over(order))
        .where(F.col("rk") <= k)
        .select("win_start_ms", F.col("rk").cast("bigint").alias("rk"), key, value)
    )


def ranking_lines(ranked: DataFrame, key: str, value: Column) -> DataFrame:
    """One line per window: ``start, key, value, key, value, …`` in rank order.

    The group holds at most k rows per window.
    """
    entry = F.struct("rk", F.concat_ws(", ", F.col(key), value.cast("string")).alias("text"))
    entries = F.array_sort(F.collect_list(entry))
    return (
        ranked.groupBy("win_start_ms")
        .agg(F.array_join(entries.getField("text"), ", ").alias("text"))
        .select("win_start_ms", F.concat_ws(", ", "win_start_ms", "text").alias("line"))
    )


def pivot_lines(slots: DataFrame, label: bool = False) -> DataFrame:
    """One line per window: ``start, c1, …, c12``, the start in milliseconds or as a date."""
    start = F.col("win_start_ms")
    shown = window_label(F.timestamp_millis(start)) if label else start
    cells = [c for c in slots.columns if c != "win_start_ms"]
    return slots.select("win_start_ms", F.concat_ws(", ", shown, *cells).alias("line"))
