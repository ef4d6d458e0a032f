"""Comment frames derived from a generic event table, and raw lines derived from those."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadpulse.schema import COMMENTS, EVENTS, WIRE_COLUMNS
from threadpulse.session import use_utc

# Threads are laid out by event id: depth 1, 2, 3 in turn; every 11th id has no
# known parent, every 5th depth-3 comment hangs directly under a depth-1 comment.
_COMMENT_COLUMNS = {
    "comment_id": "event_id",
    "user_id": "user_id",
    "ts": "cast(ts as timestamp)",
    "article_id": "regexp_extract(props, '[0-9]+', 0)",
    "comment_type": """case event_type when 'purchase' then 'userReply'
        when 'error' then 'reporterReply' else 'comment' end""",
    "depth": "cast(event_id % 3 + 1 as int)",
    "in_reply_to": """case when event_id % 3 = 0 then 0 when event_id % 11 = 0 then -1
        when event_id % 3 = 2 and event_id % 5 = 0 then event_id - 2 else event_id - 1 end""",
    "recommendations": "cast(floor(value) as int)",
    "editors_selection": "event_type = 'purchase'",
}


def comments_from_events(events: DataFrame) -> DataFrame:
    use_utc(events.sparkSession)
    return events.selectExpr(*[f"{_COMMENT_COLUMNS[c]} as {c}" for c in COMMENTS.names])


def load_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments_from_events(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def _pick(selector: Column, choices: list) -> Column:
    """Choice number ``selector``; the last choice for any larger number."""
    out = choices[-1]
    for i in reversed(range(len(choices) - 1)):
        out = F.when(selector == i, choices[i]).otherwise(out)
    return out


def wire_fields(comments: DataFrame) -> dict[str, Column]:
    """Raw text of each wire column of a comment, with the quoting a CSV export uses."""
    cid = F.col("comment_id")
    created = F.unix_seconds("ts")
    return {
        "approve_date": (created + 60).cast("string"),
        "article_id": F.substring(F.md5(F.col("article_id").cast("binary")), 1, 24),
        "article_word_count": (cid % 2000).cast("string"),
        "comment_id": cid.cast("string"),
        "comment_type": F.col("comment_type"),
        "create_date": created.cast("string"),
        "depth": F.col("depth").cast("string"),
        "editors_selection": F.when(F.col("editors_selection"), "True").otherwise("False"),
        "in_reply_to": F.col("in_reply_to").cast("string"),
        "parent_user_display_name": F.when(F.col("depth") == 1, "")
        .when(cid % 4 == 0, '"Lee, Ann"')
        .otherwise(F.concat(F.lit("reader"), F.col("in_reply_to"))),
        "recommendations": F.col("recommendations").cast("string"),
        "section_name": _pick(cid % 3, [F.lit("Opinion"), F.lit("World"), F.lit("")]),
        "user_display_name": _pick(
            cid % 5,
            [
                F.lit('"Diaz, M."'),
                F.lit('"Kim, J., Jr."'),
                F.lit('"Quoted"'),
                F.concat(F.lit("user"), F.col("user_id")),
            ],
        ),
        "user_id": F.col("user_id").cast("string"),
        "user_location": _pick(
            cid % 4, [F.lit('"Rome, IT"'), F.lit("Oslo"), F.lit(""), F.lit('"Paris,FR"')]
        ),
    }


# Lines with this remainder modulo 29 get the text in place of the column.
_BAD_TEXT = {
    "user_location": {0: "https://example.com/me", 10: "Rome, IT"},
    "article_word_count": {3: "n/a"},
    "comment_id": {4: "x12"},
    "create_date": {5: "12.5"},
    "depth": {6: " 2"},
    "in_reply_to": {7: ""},
    "recommendations": {8: "3000000000"},
    "user_id": {9: "anon"},
    "approve_date": {12: "soon"},
}


def raw_lines(comments: DataFrame, defects: bool = True) -> DataFrame:
    """Comments as raw lines; with ``defects``, thirteen of every 29 lines are odd in some way."""
    fields = wire_fields(comments)
    if not defects:
        line = F.concat_ws(",", *[fields[c] for c in WIRE_COLUMNS])
        return comments.select("comment_id", line.alias("value"))
    kind = F.col("comment_id") % 29
    for column, texts in _BAD_TEXT.items():
        for remainder, text in texts.items():
            fields[column] = F.when(kind == remainder, text).otherwise(fields[column])
    # Cut after 9 or 14 columns, or shifted by a leading null column.
    length = F.when(kind == 1, 9).when(kind == 11, 14).otherwise(len(WIRE_COLUMNS))
    line = F.concat_ws(",", F.slice(F.array(*[fields[c] for c in WIRE_COLUMNS]), F.lit(1), length))
    line = F.concat(F.when(kind == 2, "null,").otherwise(""), line)
    return comments.select("comment_id", line.alias("value"))


def unquoted_lines(comments: DataFrame) -> DataFrame:
    """Raw lines whose names and locations lost their quotes, so that commas split them."""
    cid = F.col("comment_id")
    fields = wire_fields(comments) | {
        "parent_user_display_name": F.lit("someone"),
        "user_display_name": _pick(
            cid % 4, [F.lit("Diaz"), F.lit("Kim, J."), F.lit("Roe, P., Jr."), F.lit("user 7")]
        ),
        "user_location": _pick(cid % 3, [F.lit("Oslo"), F.lit("Rome, IT"), F.lit("Paris, IDF, FR")]),
    }
    line = F.concat_ws(",", *[fields[c] for c in WIRE_COLUMNS])
    broken = F.concat_ws(",", *[fields[c] for c in WIRE_COLUMNS if c != "user_id"])
    # Every 37th line has no user id at all.
    return comments.select("comment_id", F.when(cid % 37 == 0, broken).otherwise(line).alias("value"))
