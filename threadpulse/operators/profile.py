"""Time span of a comment set and gaps between consecutive comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadpulse.session import ensure_checkpoint_dir

# Fixed value: target length of a replay of the whole set, in seconds.
REPLAY_SECONDS = 600


def time_span(comments: DataFrame) -> DataFrame:
    """First and last event time, their distance, and the replay factor for it."""
    return (
        comments.agg(
            F.unix_millis(F.min("ts")).alias("first_ms"),
            F.unix_millis(F.max("ts")).alias("last_ms"),
        )
        .withColumn("span_seconds", (F.col("last_ms") - F.col("first_ms")) / 1000)
        .withColumn("replay_factor", F.try_divide(F.lit(REPLAY_SECONDS), F.col("span_seconds")))
    )


def _gap_seconds(previous_ts) -> F.Column:
    micros = F.unix_micros("ts") - F.unix_micros(previous_ts)
    return (micros / 1_000_000).alias("gap_seconds")


def _gaps_by_range(df: DataFrame, key: str, slices: int) -> DataFrame:
    """Gaps within each key, of whatever size; NULL is a key like any other.

    The rows are cut into ranges of (key, ts, comment_id), whatever their
    distribution, and each range is one group of the window. Only the first row
    of a range needs the last row of the range before it; there is one such row
    per range. A running row number lets the cut pass through a group of equal
    copies. The ranges are checkpointed because both steps must see the same cut,
    also after an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.withColumn("copy", F.monotonically_increasing_id())
        .repartitionByRange(slices, key, "ts", "comment_id", "copy")
        .select(key, "ts", "comment_id", F.spark_partition_id().alias("slice"))
        .checkpoint()
    )
    tails = ranged.groupBy("slice").agg(
        F.max(F.struct(F.col(key).alias("k"), "ts", "comment_id")).alias("tail")
    )
    # One row per range, at most `slices`.
    before = tails.select("slice", F.lag("tail").over(Window.orderBy("slice")).alias("tail"))
    order = Window.partitionBy("slice").orderBy(key, "ts", "comment_id")
    here = F.lag(F.struct(F.col(key).alias("k"), "ts", "comment_id")).over(order)
    joined = ranged.withColumn("here", here).join(F.broadcast(before), "slice")
    previous = F.coalesce("here", "tail")
    same_key = F.when(previous["k"].eqNullSafe(F.col(key)), previous["ts"])
    return joined.select(key, "comment_id", "ts", _gap_seconds(same_key))


def interarrival_gaps(
    comments: DataFrame,
    key: str | None = "user_id",
    slices: int | None = None,
) -> DataFrame:
    """Seconds since the previous comment of the same key; NULL for its first one.

    Order is event time, then comment id. ``key=None`` takes the whole set as one
    sequence. ``slices`` is the number of ranges.
    """
    slices = slices or int(comments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if key is None:
        whole = comments.select(F.lit(0).alias("seq"), "comment_id", "ts")
        return _gaps_by_range(whole, "seq", slices).drop("seq")
    return _gaps_by_range(comments.select(key, "comment_id", "ts"), key, slices)
