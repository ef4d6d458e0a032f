"""Every query by name, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadpulse.functions import time as tf
from threadpulse.functions.text import is_integer
from threadpulse.operators import counts, filters, profile, threads
from threadpulse.operators.ranking import pivot_lines
from threadpulse.operators.windows import (
    DAY,
    HOUR,
    MONTH,
    ORIGIN_DAY,
    ORIGIN_MONTH,
    ORIGIN_WEEK,
    WEEK,
    Span,
    assign_window,
)
from threadpulse.plans import kept, slots, top_articles, top_users
from threadpulse.sources import files, ingest, views

Query = Callable[[SparkSession, str], DataFrame]

# The row cap of the original file scan.
SCAN_ROWS = 9_999


def _over_comments(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(views.load_comments(spark, sf_dir))


def _over_valid(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_comments(lambda c: build(filters.valid_users(c)))


def _with_ms(df: DataFrame) -> DataFrame:
    """Event time as epoch milliseconds, which reads the same in every engine."""
    return df.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_ms")


def _bigint(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _filtered(keep: Callable[[DataFrame], DataFrame]) -> Query:
    columns = ["comment_id", "user_id", "ts", "comment_type"]
    return _over_comments(lambda c: _with_ms(keep(c).select(*columns)))


def _per_comment(name: str, value: Callable[[str], F.Column]) -> Query:
    return _over_comments(lambda c: c.select("comment_id", value("ts").cast("bigint").alias(name)))


def _credit_rows(df: DataFrame) -> DataFrame:
    return df.select(F.unix_millis("ts").alias("ts_ms"), "author", "cents")


def _is_numeric(comments: DataFrame) -> DataFrame:
    """How many raw lines have an integer at each comma-separated position."""
    pieces = views.raw_lines(comments).select(F.posexplode(F.split("value", ",", -1)).alias("pos", "p"))
    return pieces.groupBy(F.col("pos").cast("bigint").alias("pos")).agg(
        F.count_if(is_integer(F.col("p"))).alias("n_integer"), F.count("*").alias("n")
    )


def _window_label(comments: DataFrame) -> DataFrame:
    return (
        assign_window(comments.select("ts"), DAY)
        .groupBy("window")
        .agg(F.count("*").alias("n"))
        .select(tf.window_label("window.start").alias("label"), "n")
    )


def _ingest_valid(comments: DataFrame) -> DataFrame:
    good = ingest.valid_comments(ingest.parse_lines(views.raw_lines(comments)))
    return _with_ms(_bigint(good, "article_word_count", "depth", "recommendations"))


def _serialize(comments: DataFrame) -> DataFrame:
    return files.serialize(ingest.parse_lines(views.raw_lines(comments)))


def _repair(comments: DataFrame) -> DataFrame:
    return ingest.repair_lines(views.unquoted_lines(comments)).withColumnRenamed("value", "line")


def _scan_limit(comments: DataFrame) -> DataFrame:
    return _with_ms(files.first_rows(comments.select("comment_id", "user_id", "ts"), SCAN_ROWS))


def _gaps(key: str | None) -> Query:
    def run(comments: DataFrame) -> DataFrame:
        return profile.interarrival_gaps(comments, key).drop("ts")

    return _over_comments(run)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}

    def windowed(prefix: str, plan: Callable[[DataFrame, Span], DataFrame], **spans: Span) -> None:
        for name, span in spans.items():
            key = f"{prefix}_{name}" if name else prefix
            out[key] = _over_comments(lambda c, span=span: plan(c, span))

    short = {"hour": HOUR, "day": DAY, "week": WEEK}
    long = {"day": DAY, "week": WEEK, "month": MONTH}
    origin = {
        "day_origin": ORIGIN_DAY,
        "week_origin": ORIGIN_WEEK,
        "month_origin": ORIGIN_MONTH,
    }

    windowed("top3_articles", top_articles.top_articles, **short)
    windowed("article_counts", top_articles.counts, **short)

    windowed("slots", slots.slots, **origin)
    windowed("slots", slots.slots_keyed, day_epoch=DAY)
    windowed("slot_counts", lambda c, s: _bigint(slots.slot_counts(c, s), "slot"), day=DAY)
    out["slot_first_last"] = _over_comments(
        lambda c: _bigint(slots.first_last(c, DAY), "slot", "first_weekday")
    )

    windowed("top10_users", top_users.top_users, **long)
    windowed("user_score", top_users.scores, **long)
    out["like_score"] = _over_comments(lambda c: top_users.like_scores(c, DAY))
    out["reply_score_by_level"] = _over_comments(
        lambda c: _bigint(top_users.reply_scores_by_level(c, DAY), "level")
    )

    out["reply_links"] = _over_valid(threads.reply_links)
    out["reply_credits_l2"] = _over_valid(lambda c: _credit_rows(threads.credits_under_replies(c)))
    out["reply_credits_l1"] = _over_valid(lambda c: _credit_rows(threads.credits_under_roots(c)))
    out["orphan_replies"] = _over_valid(lambda c: _bigint(threads.orphan_replies(c), "depth"))
    out["latest_link"] = _over_valid(threads.latest_links)

    out["link_records"] = _over_valid(threads.link_records)

    out["filter_valid"] = _filtered(filters.valid_users)
    out["filter_direct"] = _filtered(filters.direct_comments)
    out["hour_slot"] = _per_comment("slot", tf.hour_slot)
    out["hour_of_day"] = _per_comment("hour", tf.hour_of_day)
    out["weekday"] = _per_comment("weekday", tf.weekday)
    out["is_numeric"] = _over_comments(_is_numeric)
    out["window_label"] = _over_comments(_window_label)
    out["result_lines"] = _over_comments(lambda c: top_articles.lines(top_articles.top_articles(c, DAY)))
    out["result_lines_users"] = _over_comments(lambda c: top_users.lines(top_users.top_users(c, DAY)))
    out["result_lines_slots"] = _over_comments(lambda c: pivot_lines(slots.slots(c, DAY), label=True))
    out["serialize_rows"] = _over_comments(_serialize)

    out["ingest_valid"] = _over_comments(_ingest_valid)
    out["ingest_reject_counts"] = _over_comments(
        lambda c: ingest.reject_counts(ingest.parse_lines(views.raw_lines(c)))
    )
    out["csv_repair"] = _over_comments(_repair)
    out["scan_limit"] = _over_comments(_scan_limit)

    out["time_span"] = _over_comments(profile.time_span)
    out["interarrival_gap"] = _gaps("user_id")
    out["interarrival_gap_article"] = _gaps("article_id")
    out["interarrival_gap_stream"] = _gaps(None)

    cells = [counts.slot_name(i) for i in counts.SLOTS]
    for key, daily, span, keys, sums in (
        ("article_counts_week_days", top_articles.counts, WEEK, ["article_id"], ["n"]),
        ("user_score_month_days", top_users.scores, MONTH, ["author"], ["cents"]),
        ("slots_month_origin_days", slots.slots, ORIGIN_MONTH, [], cells),
    ):
        out[key] = _over_comments(
            lambda c, daily=daily, span=span, keys=keys, sums=sums: kept.rolled_up(c, daily, span, keys, sums)
        )
    columns = ["comment_id", "user_id", "ts"]
    out["scan_limit_days"] = _over_comments(lambda c: _with_ms(kept.first_rows(c.select(*columns), SCAN_ROWS)))
    out["stream_credits"] = _over_comments(kept.stream_credits)
    out["stream_orphans"] = _over_comments(kept.stream_orphans)
    out["stream_link_records"] = _over_comments(kept.stream_link_records)
    out["stream_gaps"] = _over_comments(kept.stream_gaps)
    out["stream_top3_articles_day"] = _over_comments(lambda c: kept.stream_top_articles(c, DAY))
    return out
