"""Windows, slots and rankings on hand-written rows, and invariants on the tables."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from threadpulse.functions import time as tf
from threadpulse.operators.ranking import top_k
from threadpulse.operators.windows import (
    DAY,
    HOUR,
    MONTH,
    ORIGIN_DAY,
    ORIGIN_MONTH,
    ORIGIN_WEEK,
    SLOT_ORIGIN_MS,
    WEEK,
    assign_window,
    closed_only,
    label_window,
)
from threadpulse.plans import slots, top_articles, top_users
from threadpulse.schema import COMMENTS
from threadpulse.sources import files, views

SF_DIR = "/root/testdata/sf0.01"


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def comment(cid, user, ts, kind="comment", depth=1, parent=0, likes=0, selected=False, article="a"):
    return (cid, user, utc(ts), article, kind, depth, parent, likes, selected)


@pytest.fixture(scope="module")
def sample(spark):
    """The worked example: two threads, an orphan, a zero score and an invalid user."""
    rows = [
        comment(1, 10, "2018-01-01 00:00:00", likes=10),
        comment(2, 11, "2018-01-01 01:59:59", likes=10, selected=True),
        comment(3, 12, "2018-01-01 02:00:00", "userReply", 2, 1, likes=5),
        comment(4, 13, "2018-01-01 22:30:00", "userReply", 3, 3),
        comment(5, 14, "2018-01-01 23:30:00", "userReply", 3, 2),
        comment(6, 15, "2018-01-02 00:00:00", "userReply", 2, 999),
        comment(7, 16, "2018-01-02 10:00:00", "userReply", 3, 6),
        comment(8, 17, "2018-01-03 12:00:00"),
        comment(9, 0, "2018-01-03 12:00:00", likes=50, selected=True),
        comment(10, 18, "2018-01-04 00:00:00", likes=1),
    ]
    return spark.createDataFrame(rows, COMMENTS)


def starts(spark, span, *times):
    df = spark.createDataFrame([(utc(t),) for t in times], "ts timestamp")
    return [r[0] for r in label_window(assign_window(df, span)).select("win_start_ms").collect()]


def ms(text: str) -> int:
    return int(utc(text).timestamp() * 1000)


def test_epoch_windows_start_where_the_result_files_do(spark):
    assert starts(spark, DAY, "2018-01-01 05:00:00") == [1514764800000]
    assert starts(spark, WEEK, "2018-01-01 05:00:00") == [1514419200000]
    assert starts(spark, MONTH, "2018-01-01 05:00:00") == [1513728000000]
    assert starts(spark, HOUR, "2018-01-01 05:59:59.999") == [ms("2018-01-01 05:00:00")]


def test_origin_windows(spark):
    assert starts(spark, ORIGIN_DAY, "2018-01-01 22:59:59", "2018-01-01 23:00:00") == [
        SLOT_ORIGIN_MS,
        SLOT_ORIGIN_MS + DAY.length_ms,
    ]
    assert starts(spark, ORIGIN_WEEK, "2018-01-07 23:00:00") == [SLOT_ORIGIN_MS + WEEK.length_ms]
    assert starts(spark, ORIGIN_MONTH, "2018-02-01 00:00:00") == [1517439600000]
    # Before the origin the grid goes on.
    assert starts(spark, ORIGIN_DAY, "2017-12-31 22:00:00") == [SLOT_ORIGIN_MS - DAY.length_ms]


def test_week_starts_on_thursday(spark):
    before, after = starts(spark, WEEK, "2018-01-03 23:59:59", "2018-01-04 00:00:00")
    assert after - before == WEEK.length_ms


def test_slot_and_weekday_edges(spark):
    df = spark.createDataFrame(
        [(utc(f"2018-01-07 {h:02d}:59:59"),) for h in range(24)], "ts timestamp"
    )
    got = df.select(tf.hour_slot("ts"), tf.hour_of_day("ts"), tf.weekday("ts")).collect()
    assert [r[0] for r in got] == [h // 2 + 1 for h in range(24)]
    assert [r[1] for r in got] == list(range(24))
    assert {r[2] for r in got} == {0}  # a Sunday


def test_slots_of_the_sample(sample):
    got = {r.win_start_ms: r for r in slots.slots(sample, DAY).collect()}
    first = got[ms("2018-01-01 00:00:00")]
    assert (first.s01, first.s02, first.s12) == (2, 0, 0)
    # User 0 is dropped; replies are not direct comments; empty days have no row.
    assert got[ms("2018-01-03 00:00:00")].s07 == 1
    assert ms("2018-01-02 00:00:00") not in got


def test_scores_of_the_sample(sample):
    got = {
        (r.win_start_ms, r.author): r.cents for r in top_users.scores(sample, DAY).collect()
    }
    day = [ms(f"2018-01-0{d} 00:00:00") for d in (1, 2, 3, 4)]
    assert got == {
        (day[0], 10): 300 + 70 + 70,
        (day[0], 11): 330 + 70,
        (day[0], 12): 70,
        (day[2], 17): 0,
        (day[3], 18): 30,
    }
    levels = {
        (r.author, r.level): r.cents for r in top_users.reply_scores_by_level(sample, WEEK).collect()
    }
    assert levels == {(10, 1): 70, (10, 2): 70, (12, 2): 70, (11, 2): 70}


def test_ranking_lines_of_the_sample(sample):
    got = [r.line for r in top_users.lines(top_users.top_users(sample, DAY)).collect()]
    assert f"{ms('2018-01-01 00:00:00')}, 10, 4.4, 11, 4.0, 12, 0.7" in got
    assert f"{ms('2018-01-03 00:00:00')}, 17, 0.0" in got


def test_ties_rank_by_key(spark):
    rows = [(0, "b", 5), (0, "a", 5), (0, "c", 7), (0, "d", 5), (1, "z", 1)]
    df = spark.createDataFrame(rows, "win_start_ms long, article_id string, n long")
    got = [tuple(r) for r in top_k(df, 3, "n", "article_id").orderBy("win_start_ms", "rk").collect()]
    assert got == [(0, 1, "c", 7), (0, 2, "a", 5), (0, 3, "b", 5), (1, 1, "z", 1)]


def test_single_file_of_lines(spark, sample, tmp_path):
    lines = top_articles.lines(top_articles.top_articles(sample, DAY))
    files.write_lines(lines, f"{tmp_path}/out")
    files.write_lines(lines, f"{tmp_path}/out")  # replaces
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    got = [r[0] for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert got == sorted(got) and len(got) == 4


def test_slot_lines(sample):
    from threadpulse.operators.ranking import pivot_lines

    report = slots.slots(sample, DAY)
    got = {r.win_start_ms: r.line for r in pivot_lines(report).collect()}
    first = ms("2018-01-01 00:00:00")
    assert got[first] == f"{first}, 2" + ", 0" * 11
    labelled = {r.win_start_ms: r.line for r in pivot_lines(report, label=True).collect()}
    assert labelled[first] == "Mon Jan 01 00:00:00 UTC 2018, 2" + ", 0" * 11


def test_audit_column(sample):
    assert top_articles.counts(sample, DAY, audit=True).columns[-1] == "processed_at"


def test_window_label(spark):
    df = spark.createDataFrame([(utc("2018-01-01 00:00:00"),)], "ts timestamp")
    assert df.select(tf.window_label("ts")).first()[0] == "Mon Jan 01 00:00:00 UTC 2018"


@pytest.fixture(scope="module")
def comments(spark):
    return views.load_comments(spark, SF_DIR).cache()


SLOT_COLUMNS = [f"s{i:02d}" for i in range(1, 13)]


@pytest.mark.parametrize("coarse", [ORIGIN_WEEK, ORIGIN_MONTH])
def test_days_add_up_to_coarser_windows(comments, coarse):
    days = slots.slots(comments, ORIGIN_DAY)
    start = F.col("win_start_ms") - F.pmod(
        F.col("win_start_ms") - SLOT_ORIGIN_MS, F.lit(coarse.length_ms)
    )
    summed = days.groupBy(start.alias("win_start_ms")).agg(*[F.sum(c).alias(c) for c in SLOT_COLUMNS])
    assert sorted(map(tuple, summed.collect())) == sorted(
        map(tuple, slots.slots(comments, coarse).collect())
    )


def test_slots_cover_all_direct_comments(comments):
    total = slots.slots(comments, DAY).select(sum(F.sum(c) for c in SLOT_COLUMNS)).first()[0]
    direct = comments.where((F.col("user_id") != 0) & F.col("comment_type").contains("comment"))
    assert total == direct.count()
    assert slots.slots(comments, DAY).exceptAll(slots.slots_keyed(comments, DAY)).count() == 0


def test_top_rows_are_the_head_of_the_full_ranking(comments):
    full = top_articles.counts(comments, DAY)
    top = top_articles.top_articles(comments, DAY)
    assert top.join(full, ["win_start_ms", "article_id", "n"], "left_anti").count() == 0
    worst = top.groupBy("win_start_ms").agg(F.min("n").alias("worst"))
    better = full.join(top, ["win_start_ms", "article_id"], "left_anti").join(worst, "win_start_ms")
    assert better.where("n > worst").count() == 0


def test_daily_score_never_exceeds_the_week(comments):
    week = top_users.scores(comments, WEEK)
    day = top_users.scores(comments, DAY).select(
        (F.col("win_start_ms") - F.pmod("win_start_ms", F.lit(WEEK.length_ms))).alias("win_start_ms"),
        "author",
        F.col("cents").alias("day_cents"),
    )
    joined = day.join(week, ["win_start_ms", "author"], "left")
    assert joined.where("cents IS NULL OR day_cents > cents").count() == 0


def test_closed_only_leaves_the_open_window(comments):
    newest = comments.agg(F.unix_millis(F.max("ts"))).first()[0]
    days = top_articles.counts(comments, DAY)
    closed = closed_only(days, DAY, newest).select("win_start_ms").distinct().count()
    assert closed == days.select("win_start_ms").distinct().count() - 1
