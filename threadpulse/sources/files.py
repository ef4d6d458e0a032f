"""Reading lines and writing results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadpulse.schema import WIRE_COLUMNS


def read_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Raw lines of a CSV file, without its header line.

    The header is told apart by its content: in a split file only one task sees
    it, and which one is not known.
    """
    lines = spark.read.text(path)
    if not header:
        return lines
    return lines.where(~F.regexp_replace("value", "[_\\s\"]", "").ilike("approvedate,%"))


def first_rows(comments: DataFrame, n: int) -> DataFrame:
    """The first n comments in event order.

    Counts per hour give the hour in which row n falls; only rows up to its end are read and ranked.
    """
    hour = F.date_trunc("hour", "ts")
    counts = comments.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1))
    needed = counts.withColumn("earlier", F.coalesce(earlier, F.lit(0))).where(F.col("earlier") < n)
    end = needed.agg(F.max(F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("end")).scalar()
    early = comments.where(F.col("ts").isNull() | (F.col("ts") < end))
    return early.orderBy("ts", "comment_id").limit(n)


# Labels of the debug text form and whether the value is quoted.
_DEBUG_FORM = {
    "approve_date": ("approveDate", False),
    "article_id": ("articleID", True),
    "article_word_count": ("articleWordCount", False),
    "comment_id": ("commentID", False),
    "comment_type": ("commentType", True),
    "create_date": ("createDate", False),
    "depth": ("depth", False),
    "editors_selection": ("editorsSelection", False),
    "in_reply_to": ("inReplyTo", False),
    "parent_user_display_name": ("parentUserDisplayName", True),
    "recommendations": ("recommendations", False),
    "section_name": ("sectionName", True),
    "user_display_name": ("userDisplayName", True),
    "user_id": ("userID", False),
    "user_location": ("userLocation", True),
    "error": ("ERROR", True),
}


def debug_text(df: DataFrame) -> Column:
    """``Comment{label=value, …}`` over those wire columns the frame has."""

    def part(column: str) -> Column:
        label, quoted = _DEBUG_FORM[column]
        mark = "'" if quoted else ""
        shown = F.coalesce(F.col(column).cast("string"), F.lit("null"))
        return F.concat(F.lit(f"{label}={mark}"), shown, F.lit(mark))

    present = [c for c in [*WIRE_COLUMNS, "error"] if c in df.columns]
    return F.concat(F.lit("Comment{"), F.concat_ws(", ", *[part(c) for c in present]), F.lit("}"))


def serialize(df: DataFrame, form: str = "text") -> DataFrame:
    """One text record per row, as debug text or as JSON."""
    record = debug_text(df) if form == "text" else F.to_json(F.struct("*"))
    return df.select(record.alias("value"))


def write_lines(lines: DataFrame, path: str, single_file: bool = True) -> None:
    """Write result lines as text, replacing what is there.

    Results have one short line per window. The exchange before the single file
    keeps the aggregation itself parallel.
    """
    if single_file:
        lines = lines.repartition(1)
    lines.sortWithinPartitions("win_start_ms").select("line").write.mode("overwrite").text(path)
