"""Direct comments per two-hour slot of the day, one row per window."""

from __future__ import annotations

from pyspark.sql import DataFrame

from threadpulse.operators import counts as ops
from threadpulse.operators.filters import direct_comments
from threadpulse.operators.windows import Span, label_window


def slots(comments: DataFrame, span: Span) -> DataFrame:
    """Twelve counters per window in one aggregate."""
    return label_window(ops.slot_columns(direct_comments(comments), span))


def slot_counts(comments: DataFrame, span: Span) -> DataFrame:
    return label_window(ops.slot_counts(direct_comments(comments), span))


def slots_keyed(comments: DataFrame, span: Span) -> DataFrame:
    """The same report by way of per-slot counts and a pivot."""
    counted = ops.slot_counts(direct_comments(comments), span)
    return label_window(ops.pivot_slots(counted, span))


def first_last(comments: DataFrame, span: Span) -> DataFrame:
    return label_window(ops.slot_first_last(direct_comments(comments), span))
