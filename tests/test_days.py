"""Tables by day, coarser windows from day rows, and what streams keep of time."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from threadpulse.operators import profile, rollup
from threadpulse.operators.windows import DAY, HOUR, MONTH, ORIGIN_DAY, ORIGIN_MONTH, ORIGIN_WEEK, WEEK
from threadpulse.plans import slots, top_articles, top_users
from threadpulse.sources import days, files, views
from threadpulse.streaming import jobs

SF_DIR = "/root/testdata/sf0.01"
SLOTS = [f"s{i:02d}" for i in range(1, 13)]


@pytest.fixture(scope="module")
def comments(spark):
    return views.load_comments(spark, SF_DIR)


@pytest.fixture(scope="module")
def table(spark, comments, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('days')}/comments"
    days.write_days(comments, path)
    return days.read_days(spark, path, comments.schema)


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files of the scans in the plan as it ran."""
    df.collect()
    node, out = df._jdf.queryExecution().executedPlan(), []

    def walk(n):
        if n.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(n.executedPlan())
        if n.nodeName().startswith("Scan parquet") or n.getClass().getSimpleName() == "FileSourceScanExec":
            out.append(n.metrics().apply("numFiles").value())
        if n.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(n.plan())
        children = n.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(node)
    return out


def test_days_hold_all_rows_and_windows_read_their_own(table, comments):
    assert rows(table.drop("day")) == rows(comments)
    n_days = table.select("day").distinct().count()
    start = table.agg(F.unix_millis(F.min("ts"))).first()[0] // DAY.length_ms * DAY.length_ms
    week = days.between(table, start, start + 2 * DAY.length_ms)
    direct = comments.where(F.unix_millis("ts").between(start, start + 2 * DAY.length_ms - 1))
    assert rows(week.drop("day")) == rows(direct) and direct.count() > 0
    assert "PartitionFilters: [isnotnull(day" in plan(week)
    assert max(files_read(week)) <= 3 < n_days


@pytest.mark.parametrize("n", [1, 700, 9_999, 10**6])
def test_row_cap_reads_the_days_it_needs(table, comments, n):
    first = days.first_rows(table, n, "ts", "comment_id")
    assert rows(first) == rows(files.first_rows(comments, n))
    assert "PartitionFilters: [(isnull(day" in plan(first) and "Subquery" in plan(first)
    if n == 1:
        assert min(files_read(first)) == 1


def test_writing_a_day_again_replaces_it_alone(spark, comments, tmp_path):
    path = f"{tmp_path}/t"
    days.write_days(comments, path)
    day = comments.agg(F.min(F.to_date("ts"))).first()[0]
    days.write_days(comments.where(F.to_date("ts") == day).limit(1), path)
    left = days.read_days(spark, path, comments.schema)
    assert left.where(F.col("day") == day).count() == 1
    others = comments.where(F.to_date("ts") != day)
    assert left.where(F.col("day") != day).count() == others.count()


REPORTS = {
    "articles": (top_articles.counts, [DAY, WEEK, MONTH], ["article_id"], ["n"]),
    "scores": (top_users.scores, [DAY, WEEK, MONTH], ["author"], ["cents"]),
    "slots": (slots.slots, [ORIGIN_DAY, ORIGIN_WEEK, ORIGIN_MONTH], [], SLOTS),
    "slot counts": (slots.slot_counts, [WEEK], ["slot"], ["n"]),
}


@pytest.mark.parametrize("name", REPORTS)
def test_coarser_windows_equal_direct_ones(spark, comments, tmp_path, name):
    daily, spans, keys, sums = REPORTS[name]
    report = rollup.DayTable(spark, f"{tmp_path}/t", daily, spans[0], keys, sums)
    report.update(comments)
    for span in spans:
        assert rows(report.report(span)) == rows(daily(comments, span))
    again = rollup.DayTable(spark, f"{tmp_path}/t", daily, spans[0], keys, sums)  # another job
    assert rows(again.report(spans[-1])) == rows(daily(comments, spans[-1]))
    text = plan(again.report(spans[-1]))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1 and "events" not in text


def test_a_changed_day_is_computed_alone(spark, comments, tmp_path):
    report = rollup.DayTable(spark, f"{tmp_path}/t", top_articles.counts, DAY, ["article_id"], ["n"])
    report.update(comments)
    day = comments.agg(F.min(F.to_date("ts"))).first()[0]
    more = comments.unionByName(comments.where(F.to_date("ts") == day))
    report.update(more.where(F.to_date("ts") == day))
    assert rows(report.report(WEEK)) == rows(top_articles.counts(more, WEEK))


def test_other_grids_are_refused(spark):
    report = rollup.DayTable(spark, "nowhere", slots.slots, ORIGIN_WEEK, [], SLOTS)
    with pytest.raises(ValueError, match="grid"):
        report.report(WEEK)
    with pytest.raises(ValueError, match="days"):
        rollup.day_span(HOUR)


# --- streams


@pytest.fixture
def inbox(spark, tmp_path):
    """Comments in files in event order, a little shuffled inside each."""
    comments = views.load_comments(spark, "/root/testdata/sf0.001").select("comment_id", "user_id", "ts")
    path = f"{tmp_path}/in"
    bounds = comments.agg(F.expr("percentile_approx(ts, array(0.3, 0.6, 1.0))")).first()[0]
    low = None
    for bound in bounds:
        part = comments.where(F.col("ts") <= bound)
        part = part if low is None else part.where(F.col("ts") > low)
        part.orderBy(F.xxhash64("comment_id")).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
        low = bound
    yield path, comments
    for key in jobs.STATE_CONF:
        spark.conf.unset(key)


def finish(query):
    query.awaitTermination(240)
    assert query.exception() is None
    return query


def stream(spark, path):
    return spark.readStream.schema("comment_id bigint, user_id bigint, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_gaps_equal_batch_on_closed_rows(spark, inbox, tmp_path):
    path, comments = inbox
    finish(jobs.gaps(stream(spark, path), f"{tmp_path}/out", f"{tmp_path}/cp"))
    newest = comments.agg(F.max("ts")).first()[0]
    closed = F.unix_millis("ts") <= int(newest.timestamp() * 1000) - 1000
    want = profile.interarrival_gaps(comments).where(closed)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert want.count() > 900
    assert rows(got) == rows(want)


def test_stream_gaps_of_equal_times_and_a_late_row(spark, tmp_path):
    path = f"{tmp_path}/in"
    at = "2018-01-01 00:00:"
    for batch in (
        [(3, 7, "05"), (2, 7, "05"), (1, 7, "01"), (9, None, "02"), (8, None, "04")],
        [(4, 7, "06"), (5, 7, "30")],
        [(6, 7, "03"), (7, 7, "59")],  # 6 is late
    ):
        rows_of = [(c, u, at + s) for c, u, s in batch]
        part = spark.createDataFrame(rows_of, "comment_id bigint, user_id bigint, ts string").withColumn("ts", F.to_timestamp("ts"))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    try:
        query = finish(jobs.gaps(stream(spark, path), f"{tmp_path}/out", f"{tmp_path}/cp"))
        dropped = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    finally:
        for key in jobs.STATE_CONF:
            spark.conf.unset(key)
    got = spark.read.parquet(f"{tmp_path}/out").select("user_id", "comment_id", "gap_seconds")
    want = [(7, 1, None), (7, 2, 4.0), (7, 3, 0.0), (7, 4, 1.0), (7, 5, 24.0), (None, 8, 2.0), (None, 9, None)]
    assert dropped == 1 and sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_running_span_after_each_trigger(spark, inbox, tmp_path):
    path, comments = inbox
    finish(jobs.time_span(stream(spark, path), f"{tmp_path}/out", f"{tmp_path}/cp"))
    spans = spark.read.parquet(f"{tmp_path}/out")
    assert spans.count() == 3
    last = [r["last_ms"] for r in spans.orderBy("batch").collect()]
    assert last == sorted(set(last))
    assert rows(jobs.latest_time_span(spark, f"{tmp_path}/out")) == rows(profile.time_span(comments))
    newest = comments.select((F.unix_millis(F.max("ts")) + 1).alias("x")).first()[0]
    late = spark.createDataFrame([(10**6, 1, newest)], "comment_id bigint, user_id bigint, ts bigint").withColumn("ts", F.timestamp_millis("ts"))
    late.coalesce(1).write.mode("append").parquet(path)
    finish(jobs.time_span(stream(spark, path), f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert jobs.latest_time_span(spark, f"{tmp_path}/out").first()["last_ms"] == newest
