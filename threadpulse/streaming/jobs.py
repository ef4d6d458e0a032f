"""The three questions as streaming queries.

Aggregates run in append mode: a window is emitted once, when the watermark has
passed its end, with all its keys in the same micro-batch. Ranking happens in one
of two ways with the same rows. ``rank="batch"`` ranks each micro-batch with the
batch operators, all in the JVM. ``rank="plan"`` ranks in the plan of the stream
(``streaming.ranking``), so that the result can feed any sink or another stream.
Either keeps at most k rows per task or bucket and window; nothing gathers a
whole window in one place.

Rows are filtered before the watermark, so a rejected row cannot move it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadpulse.operators import counts, profile
from threadpulse.operators.filters import direct_comments, valid_users
from threadpulse.operators.ranking import pivot_lines
from threadpulse.operators.windows import Span, assign_window, label_window
from threadpulse.plans import top_articles as articles_plan
from threadpulse.plans import top_users as users_plan
from threadpulse.sources.files import write_lines
from threadpulse.streaming.credits import DEFAULT_DELAY, DEFAULT_SALTS, credits, orphan_replies
from threadpulse.streaming.gaps import interarrival_gaps
from threadpulse.streaming.ranking import best_per_window

# Keeps join and window state on local disk with an incremental log, off the heap.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_disk_state(spark: SparkSession) -> None:
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)


def _start(
    result: DataFrame,
    path: str,
    checkpoint: str,
    rows: Callable[[DataFrame], DataFrame],
    lines: Callable[[DataFrame], DataFrame],
    sink: str,
    available_now: bool,
) -> StreamingQuery:
    """Write each micro-batch to a folder of its own, as rows or as result lines.

    A batch that is run again after a failure overwrites its folder, so the
    output holds every window exactly once. The console sink prints every line,
    fetched one partition at a time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        if sink == "parquet":
            rows(batch).write.mode("overwrite").parquet(folder)
        elif sink == "text":
            write_lines(lines(rows(batch)), folder)
        else:
            for row in lines(rows(batch)).orderBy("win_start_ms").toLocalIterator():
                print(row["line"])

    writer = result.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write).start()


def top_articles(
    comments: DataFrame,
    span: Span,
    path: str,
    checkpoint: str,
    delay: str = DEFAULT_DELAY,
    k: int = articles_plan.TOP_ARTICLES,
    sink: str = "parquet",
    available_now: bool = True,
    rank: str = "batch",
) -> StreamingQuery:
    timed = valid_users(comments).withWatermark("ts", delay)
    counted = counts.article_counts(timed, span)
    if rank == "plan":
        best = top_rows(counted, span, k, "n", "article_id")
        return _start(best, path, checkpoint, lambda b: b, articles_plan.lines, sink, available_now)

    def ranked(batch: DataFrame) -> DataFrame:
        return articles_plan.ranking(batch, k)

    return _start(label_window(counted), path, checkpoint, ranked, articles_plan.lines, sink, available_now)


def top_rows(scored: DataFrame, span: Span, k: int, value: str, key: str) -> DataFrame:
    """The k best keys of each closed window as a stream; their state is kept on disk."""
    use_disk_state(scored.sparkSession)
    return best_per_window(scored, span, k, value, key)


def slots(
    comments: DataFrame,
    span: Span,
    path: str,
    checkpoint: str,
    delay: str = DEFAULT_DELAY,
    keyed: bool = False,
    sink: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Slot report; ``keyed`` counts per slot first and pivots the closed counts."""
    timed = direct_comments(comments).withWatermark("ts", delay)
    if keyed:
        report = counts.pivot_slots(counts.slot_counts(timed, span), span)
    else:
        report = counts.slot_columns(timed, span)
    report = label_window(report)
    return _start(report, path, checkpoint, lambda b: b, pivot_lines, sink, available_now)


def resolve_credits(
    comments: DataFrame,
    path: str,
    checkpoint: str,
    horizon: str | None = None,
    delay: str = DEFAULT_DELAY,
    salts: int = DEFAULT_SALTS,
    available_now: bool = True,
) -> StreamingQuery:
    """First half of the user ranking: append every credit to a table.

    Cutting the job here lets the ranking follow the credits' own event time. A
    credit that was given under an author whom a later copy of the parent
    replaced is appended again with n = -1. Links and replies stay in state for
    good unless a horizon is set, so state is kept on disk.
    """
    return _append(credits(comments, horizon, delay, salts), path, checkpoint, available_now)


def audit_orphans(
    comments: DataFrame,
    path: str,
    checkpoint: str,
    horizon: str | None = None,
    delay: str = DEFAULT_DELAY,
    salts: int = DEFAULT_SALTS,
    available_now: bool = True,
) -> StreamingQuery:
    """Append every reply whose parent is unknown to a table, and once more with n = -1 when the parent comes."""
    return _append(orphan_replies(comments, horizon, delay, salts), path, checkpoint, available_now)


def _append(rows: DataFrame, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    use_disk_state(rows.sparkSession)
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.format("parquet").start(path)


CREDITS_SCHEMA = "ts timestamp, author bigint, cents bigint, level int, n bigint"


def top_users(
    spark: SparkSession,
    credits_path: str,
    span: Span,
    path: str,
    checkpoint: str,
    delay: str = DEFAULT_DELAY,
    k: int = users_plan.TOP_USERS,
    sink: str = "parquet",
    available_now: bool = True,
    rank: str = "batch",
) -> StreamingQuery:
    """Second half: score the credits per window and rank the closed windows.

    The table of credits is committed by whole micro-batches, and a trigger takes all files that are there.
    A cap on files would split a micro-batch, whose files are in no event-time order, and the watermark of
    the first part would drop rows of the second.

    Credits taken back cancel their counterparts; an author whose credits are all taken back is not ranked. A
    window that is closed stays as it was.
    """
    stored = spark.readStream.schema(CREDITS_SCHEMA).parquet(credits_path)
    scored = net_scores(stored.withWatermark("ts", delay), span)
    if rank == "plan":
        best = top_rows(scored, span, k, "cents", "author")
        return _start(best, path, checkpoint, lambda b: b, users_plan.lines, sink, available_now)

    def ranked(batch: DataFrame) -> DataFrame:
        return users_plan.ranking(batch, k)

    return _start(label_window(scored), path, checkpoint, ranked, users_plan.lines, sink, available_now)


def net_scores(credits: DataFrame, span: Span) -> DataFrame:
    """Cents per window and author who has credits left."""
    scored = assign_window(credits, span).groupBy("window", "author")
    return scored.agg(F.sum("cents").alias("cents"), F.sum("n").alias("n")).where("n > 0").drop("n")


def gaps(
    comments: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "user_id",
    delay: str = DEFAULT_DELAY,
    available_now: bool = True,
) -> StreamingQuery:
    """Append each comment with the seconds since the one before it of the same key, once the watermark has passed."""
    return _append(interarrival_gaps(comments.withWatermark("ts", delay), key), path, checkpoint, available_now)


def time_span(comments: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the time span of all rows so far: one row of state, and a folder for each trigger that changed it.

    A trigger that runs again replaces its folder; ``latest_time_span`` reads the newest.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    use_disk_state(comments.sparkSession)
    writer = profile.time_span(comments).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write).start()


def latest_time_span(spark: SparkSession, path: str) -> DataFrame:
    """The span after the last trigger."""
    spans = spark.read.parquet(path)
    newest = spans.agg(F.max("batch").alias("batch")).scalar()
    return spans.where(F.col("batch") == newest).drop("batch")
