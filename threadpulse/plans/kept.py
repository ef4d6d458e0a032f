"""Queries over what is kept between runs: tables by day, and tables that streams write.

Each query builds its tables from the comments in a folder of its own and reads the result back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadpulse.operators.filters import valid_users
from threadpulse.operators.rollup import Daily, DayTable
from threadpulse.operators.windows import Span
from threadpulse.session import shared_folder
from threadpulse.sources import days
from threadpulse.streaming import jobs, threads
from threadpulse.streaming.link_store import LinkStore, keep_links

# Triggers in which comments are delivered, and files of each.
TRIGGERS = 3
FILES = 32


def first_rows(comments: DataFrame, n: int) -> DataFrame:
    """The row cap over a table by day."""
    path = shared_folder(comments.sparkSession, "comments-by-day")
    days.write_days(comments, path)
    table = days.read_days(comments.sparkSession, path, comments.schema)
    return days.first_rows(table, n, "ts", "comment_id")


def rolled_up(comments: DataFrame, daily: Daily, span: Span, keys: list[str], sums: list[str]) -> DataFrame:
    """A report per window of span, from its day rows."""
    spark = comments.sparkSession
    report = DayTable(spark, shared_folder(spark, "report-by-day"), daily, span, keys, sums)
    report.update(comments)
    return report.report(span)


@contextmanager
def _disk_state(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in jobs.STATE_CONF}
    jobs.use_disk_state(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _streamed(comments: DataFrame, triggers: int, start: Callable[[DataFrame, str, str], StreamingQuery]) -> str:
    """Deliver the comments as a stream in so many triggers, run a job to its end and return the path it wrote to.

    A trigger takes files that many tasks wrote, as many as the deployment shuffles with and `FILES` at least. Rows are
    dealt by all their columns, so that a hot or NULL id is no hot task. One trigger takes whatever files there are.
    """
    spark = comments.sparkSession
    root = shared_folder(spark, "stream")
    files = max(FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    comments.repartition(triggers * files, F.xxhash64(*comments.columns)).write.parquet(f"{root}/in")
    source = spark.readStream.schema(comments.schema)
    if triggers > 1:
        source = source.option("maxFilesPerTrigger", files)
    source = source.parquet(f"{root}/in")
    with _disk_state(spark):
        query = start(source, f"{root}/out", f"{root}/checkpoint")
        query.awaitTermination()
    if query.exception():
        raise query.exception()
    return f"{root}/out"


def stream_credits(comments: DataFrame) -> DataFrame:
    """Credits that hold at the end of a stream of comments in no order."""
    path = _streamed(comments, TRIGGERS, jobs.resolve_credits)
    changes = comments.sparkSession.read.schema(jobs.CREDITS_SCHEMA).parquet(path)
    held = threads.settled(changes.withColumn("ts_ms", F.unix_millis("ts")).drop("ts"))
    return held.select("ts_ms", "author", F.col("level").cast("bigint").alias("level"), "n", "cents")


def stream_orphans(comments: DataFrame) -> DataFrame:
    """Replies without a known parent at the end of a stream."""
    path = _streamed(comments, TRIGGERS, jobs.audit_orphans)
    left = threads.settled(comments.sparkSession.read.parquet(path))
    return left.select("comment_id", F.col("depth").cast("bigint").alias("depth"), "in_reply_to")


def stream_link_records(comments: DataFrame) -> DataFrame:
    """The lasting table of links after a stream, as text records."""
    path = _streamed(comments, TRIGGERS, lambda source, out, checkpoint: keep_links(source, out, checkpoint, 2))
    return LinkStore(comments.sparkSession, path).link_records()


def stream_gaps(comments: DataFrame) -> DataFrame:
    """Gaps per user of all rows that the watermark has passed."""
    path = _streamed(comments.select("user_id", "comment_id", "ts"), 1, jobs.gaps)
    return comments.sparkSession.read.parquet(path).drop("ts")


def stream_top_articles(comments: DataFrame, span: Span) -> DataFrame:
    """The top articles of closed windows, ranked in the plan of the stream."""

    def start(source: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
        return jobs.top_articles(source, span, out, checkpoint, rank="plan")

    path = _streamed(valid_users(comments), 1, start)
    return comments.sparkSession.read.parquet(path).drop("batch")
