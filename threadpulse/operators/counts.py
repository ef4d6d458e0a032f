"""Windowed counts per article and per two-hour slot.

Inputs are filtered comments; every function also runs on a stream that carries
a watermark on ``ts``. Each is one hash aggregate with map-side partial sums, so
a hot article or slot shuffles one row per task and window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadpulse.functions.time import hour_slot, weekday
from threadpulse.operators.windows import Span, assign_window, regroup_window

SLOTS = range(1, 13)


def slot_name(slot: int) -> str:
    return f"s{slot:02d}"


def article_counts(comments: DataFrame, span: Span) -> DataFrame:
    return (
        assign_window(comments.select("ts", "article_id"), span)
        .groupBy("window", "article_id")
        .agg(F.count("*").alias("n"))
    )


def slot_counts(comments: DataFrame, span: Span) -> DataFrame:
    return (
        assign_window(comments.select("ts", hour_slot("ts").alias("slot")), span)
        .groupBy("window", "slot")
        .agg(F.count("*").alias("n"))
    )


def slot_columns(comments: DataFrame, span: Span) -> DataFrame:
    """One row per window with twelve counters, in a single aggregate."""
    slotted = assign_window(comments.select("ts", hour_slot("ts").alias("slot")), span)
    return slotted.groupBy("window").agg(
        *[F.count_if(F.col("slot") == i).alias(slot_name(i)) for i in SLOTS]
    )


def pivot_slots(counts: DataFrame, span: Span) -> DataFrame:
    """Turn ``slot_counts`` into twelve columns; an absent slot counts 0.

    The input has at most twelve rows per window.
    """

    def cell(slot: int) -> Column:
        value = F.sum(F.when(F.col("slot") == slot, F.col("n")))
        return F.coalesce(value, F.lit(0)).cast("bigint").alias(slot_name(slot))

    return regroup_window(counts, span).groupBy("window").agg(*[cell(i) for i in SLOTS])


def slot_first_last(comments: DataFrame, span: Span) -> DataFrame:
    """Per window and slot: count, first event time and weekday, last comment type.

    A string in an aggregate buffer would force a sort of all rows, so the type
    goes into the key first; the second aggregate sees one row per type.
    """
    slotted = comments.select("ts", "comment_type", hour_slot("ts").alias("slot"))
    per_type = (
        assign_window(slotted, span)
        .groupBy("window", "slot", "comment_type")
        .agg(
            F.count("*").alias("n"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )
    return (
        per_type.groupBy("window", "slot")
        .agg(
            F.sum("n").alias("n"),
            F.min("first_ts").alias("first_ts"),
            F.max(F.struct("last_ts", "comment_type")).alias("last"),
        )
        .select(
            "window",
            "slot",
            "n",
            F.unix_millis("first_ts").alias("first_ms"),
            weekday("first_ts").alias("first_weekday"),
            F.col("last.comment_type").alias("last_type"),
        )
    )
