"""Raw comment lines to typed comments, with a reason for every rejected line.

The functions take a frame with a string column ``value`` (a text file or a
message topic) and work the same on a batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadpulse.functions.text import blank_to_null, is_integer
from threadpulse.functions.time import event_time
from threadpulse.schema import WIRE_COLUMNS

INVALID_RECORD = "invalid record"

# Checked in wire order; the first column that fails names the error.
# The error tags.
_CHECKED = {
    "approve_date": "approvedate",
    "article_word_count": "word count",
    "comment_id": "commentid",
    "create_date": "createdate",
    "depth": "depth",
    "in_reply_to": "inreplyto",
    "recommendations": "recs",
    "user_id": "userid",
}
# Fields the CSV reader has room for. Longer lines, and only those can have more, are cut to their first fields.
_MOST_PIECES = 1_000_000
_CSV_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "null", "maxColumns": str(_MOST_PIECES + 8)}
# All wire columns, a leading null column and one extra field. A quoted field may hold commas and doubled quotes.
# Every repetition is possessive, so that the match is one pass of any length.
_FIRST_FIELDS = r'^(?s:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)(?:,|\z)){0,%d}+' % (len(WIRE_COLUMNS) + 2)

_WIDE = {"approve_date", "create_date"}
_IDS = {"comment_id", "in_reply_to", "user_id"}


def _integer_type(column: str, id_type: str) -> str:
    if column in _WIDE:
        return "bigint"
    return id_type if column in _IDS else "int"


def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters cannot drag below its own computation.

    The optimizer pushes a filter on an ordinary column under the projection that
    defines it and repeats the whole expression there. It does not do so for the
    output of a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _end(line: Column) -> Column:
    """Appended to a line as one more field: a hash of the line, which the line itself cannot hold."""
    return F.concat(F.lit("\u0003"), F.md5(line))


def _record(line: Column) -> Column:
    """The line as a struct of text fields, without a leading null column.

    The end mark shows up among the fields if the line has too few of them or
    leaves a quote open; extra fields are ignored.
    """
    end = _end(line)
    shifted = F.when(line.startswith("null,"), F.substr(line, F.lit(6))).otherwise(line)
    fits = F.length(shifted) <= _MOST_PIECES
    fields = F.when(fits, shifted).otherwise(F.regexp_extract(shifted, _FIRST_FIELDS, 0))
    schema = ", ".join(f"{c} string" for c in WIRE_COLUMNS)
    return F.from_csv(F.concat(fields, F.lit(","), end), F.lit(schema), _CSV_OPTIONS)


def _error(id_type: str) -> Column:
    value = F.col("value")
    has_url = value.contains("http:") | value.contains("https:")
    too_short = F.concat_ws("", "rec.*").contains(_end(value))
    reason = F.when(value.isNull(), INVALID_RECORD).when(has_url, "http").when(too_short, INVALID_RECORD)
    for column, tag in _CHECKED.items():
        field = F.col(f"rec.{column}")
        label = F.lit(tag)
        if column == "user_id":
            label = F.concat(F.lit("userid: "), F.coalesce(field, F.lit("null")))
        reason = reason.when(~is_integer(field, _integer_type(column, id_type)), label)
    return reason


def parse_lines(
    lines: DataFrame, id_type: str = "bigint", arrival: str | None = None, strict: bool = False
) -> DataFrame:
    """Typed columns plus ``error``, NULL for a good line.

    Commas inside double quotes belong to the field. A rejected line keeps its
    text in ``value``, has user 0 and no other typed value. ``id_type='int'``
    rejects ids beyond 32 bits. ``arrival`` names a source timestamp column to
    keep as ``arrival_time``. ``strict`` fails the query on a malformed record.
    """
    keep = [F.col("value"), *([F.col(arrival).alias("arrival_time")] if arrival else [])]
    split = _computed_once(lines.select(*keep), "rec", _record(F.col("value")))
    error = _error(id_type)
    if strict:
        broken = F.concat(F.lit("Invalid record: "), F.col("value"))
        error = F.when(error == INVALID_RECORD, F.raise_error(broken)).otherwise(error)
    checked = _computed_once(split, "error", error)
    checked = checked.withColumn("rec", F.when(F.col("error").isNull(), F.col("rec")))

    field = {c: F.col(f"rec.{c}") for c in WIRE_COLUMNS}
    typed = {c: blank_to_null(f) for c, f in field.items()}
    typed |= {c: field[c].try_cast(_integer_type(c, id_type)) for c in _CHECKED}
    typed["user_id"] = F.coalesce(typed["user_id"], F.lit(0))
    selected = F.coalesce(field["editors_selection"] != "False", F.lit(True))
    typed["editors_selection"] = F.when(F.col("error").isNull(), selected)
    typed["user_location"] = F.regexp_replace(typed["user_location"], ", *", " - ")
    out = [typed[c].alias(c) for c in WIRE_COLUMNS]
    return checked.select("value", "error", *out, *(["arrival_time"] if arrival else []))


def valid_comments(parsed: DataFrame) -> DataFrame:
    """Good lines only, with event time ``ts``; what the operators take."""
    return (
        parsed.where(F.col("error").isNull())
        .withColumn("ts", event_time("create_date"))
        .drop("value", "error")
    )


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("value", "error")


def reject_counts(parsed: DataFrame) -> DataFrame:
    return rejected_lines(parsed).groupBy("error").agg(F.count("*").alias("n"))


def repair_lines(lines: DataFrame) -> DataFrame:
    """Bring unquoted lines in ``value`` back to 15 columns; NULL if there is no user id.

    The user id is the integer at position 13, or else the first integer from
    position 12 on. Pieces before it form the name, pieces after it the location.
    The parent name of a direct comment becomes ``null``.
    """
    name, user = WIRE_COLUMNS.index("user_display_name"), WIRE_COLUMNS.index("user_id")
    parent = WIRE_COLUMNS.index("parent_user_display_name")
    kind = WIRE_COLUMNS.index("comment_type")
    p = F.col("_pieces")

    def piece(i: int | Column) -> Column:
        return F.get(p, F.lit(i) if isinstance(i, int) else i)

    def between(start: int | Column, stop: Column) -> Column:
        """Pieces from ``start`` up to, but not including, ``stop``, as one text."""
        return F.array_join(F.slice(p, F.lit(1) + start, F.greatest(stop - start, F.lit(0))), "")

    split = _computed_once(lines, "_pieces", F.split("value", ",", -1))
    integers = F.filter(
        F.transform(p, lambda text, i: F.when((i >= name) & is_integer(text), i)),
        lambda i: i.isNotNull(),
    )
    at = F.when(is_integer(piece(user)), user).otherwise(F.get(integers, F.lit(0)))
    found = _computed_once(split, "_at", at)
    at = F.col("_at")
    repaired = F.concat_ws(
        ",",
        F.slice(p, 1, parent),
        F.when(piece(kind) == "comment", "null").otherwise(piece(parent)),
        F.slice(p, parent + 2, name - parent - 1),
        between(name, at),
        piece(at),
        between(at + 1, F.size(p)),
    )
    return found.withColumn("value", F.when(at.isNotNull(), repaired)).drop("_pieces", "_at")
