"""Column layout of the comment stream."""

from __future__ import annotations

from pyspark.sql import types as T

# What every operator consumes. `sources.ingest` produces a superset of it.
COMMENTS = T.StructType(
    [
        T.StructField("comment_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("article_id", T.StringType()),
        T.StructField("comment_type", T.StringType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("in_reply_to", T.LongType()),
        T.StructField("recommendations", T.IntegerType()),
        T.StructField("editors_selection", T.BooleanType()),
    ]
)

# The event table that `sources.views` reads; stated, so that no query starts a schema scan.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# The 15 columns of a raw line, in wire order.
WIRE_COLUMNS = [
    "approve_date",
    "article_id",
    "article_word_count",
    "comment_id",
    "comment_type",
    "create_date",
    "depth",
    "editors_selection",
    "in_reply_to",
    "parent_user_display_name",
    "recommendations",
    "section_name",
    "user_display_name",
    "user_id",
    "user_location",
]
