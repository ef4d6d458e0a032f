"""Streaming results against the batch results of the same rows."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from threadpulse.operators.windows import DAY, ORIGIN_DAY, closed_only
from threadpulse.plans import slots, top_articles, top_users
from threadpulse.sources import ingest, streams, views
from threadpulse.streaming import jobs
from threadpulse.streaming.credits import credits

SF_DIR = "/root/testdata/sf0.001"
DELAY_MS = 1000


@pytest.fixture(scope="module")
def comments(spark):
    return views.load_comments(spark, SF_DIR).withColumn("ts", F.date_trunc("second", "ts"))


@pytest.fixture(scope="module")
def newest_ms(comments):
    return comments.agg(F.unix_millis(F.max("ts"))).first()[0] - DELAY_MS


def write_files(frame, folder, files=4):
    """The rows as text files, cut and delivered in event order."""
    first, last = frame.agg(F.min("comment_id"), F.max("comment_id")).first()
    step = (last - first) // files + 1
    for i in range(files):
        part = frame.where(F.col("comment_id").between(first + i * step, first + (i + 1) * step - 1))
        views.raw_lines(part, defects=False).select("value").coalesce(1).write.mode("append").text(folder)
        time.sleep(0.05)


@pytest.fixture(scope="module")
def folder(comments, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "in")
    write_files(comments, path)
    return path


def stream_of(spark, folder):
    parsed = ingest.parse_lines(streams.lines_from_folder(spark, folder, max_files=1), arrival="timestamp")
    return ingest.valid_comments(parsed)


def batch_of(spark, folder):
    return ingest.valid_comments(ingest.parse_lines(spark.read.text(folder)))


def finish(query):
    query.awaitTermination(240)
    assert query.exception() is None
    return query


def rows(df):
    columns = sorted(c for c in df.columns if c != "batch")
    return sorted(tuple(r) for r in df.select(columns).collect())


def net(credits):
    """Credits by event time, author and level: how many hold, and their cents; rows taken back cancel out."""
    n = F.sum("n") if "n" in credits.columns else F.count("*")
    sums = credits.groupBy("ts", "author", "level").agg(n.alias("n"), F.sum("cents").alias("cents"))
    assert sums.where("n < 0").count() == 0
    return rows(sums.where("n > 0"))


@pytest.fixture
def disk_state(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    jobs.use_disk_state(spark)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for key in jobs.STATE_CONF:
        spark.conf.unset(key)


def test_top_articles_equal_batch(spark, folder, newest_ms, tmp_path):
    query = jobs.top_articles(stream_of(spark, folder), DAY, f"{tmp_path}/out", f"{tmp_path}/cp")
    finish(query)
    assert len(query.recentProgress) >= 4
    want = closed_only(top_articles.top_articles(batch_of(spark, folder), DAY), DAY, newest_ms)
    assert want.count() > 60
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want)


def test_text_sink_writes_result_lines(spark, folder, newest_ms, tmp_path):
    finish(
        jobs.top_articles(
            stream_of(spark, folder), DAY, f"{tmp_path}/out", f"{tmp_path}/cp", sink="text"
        )
    )
    ranked = closed_only(top_articles.top_articles(batch_of(spark, folder), DAY), DAY, newest_ms)
    want = top_articles.lines(ranked).select("line").collect()
    got = spark.read.text(f"{tmp_path}/out/batch=*").collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in want)
    assert all(r[0].count(", ") in (2, 4, 6) for r in got)


@pytest.mark.parametrize("keyed, span", [(False, ORIGIN_DAY), (False, DAY), (True, DAY)])
def test_slots_equal_batch(spark, folder, newest_ms, tmp_path, keyed, span):
    query = jobs.slots(stream_of(spark, folder), span, f"{tmp_path}/out", f"{tmp_path}/cp", keyed=keyed)
    finish(query)
    direct = batch_of(spark, folder)
    # The watermark follows the filtered rows.
    newest = (
        direct.where(F.col("comment_type").contains("comment") & (F.col("user_id") != 0))
        .agg(F.unix_millis(F.max("ts")))
        .first()[0]
    )
    want = closed_only(slots.slots(direct, span), span, newest - DELAY_MS)
    assert want.count() > 20
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want)


def test_late_row_is_dropped_and_restart_resumes(spark, comments, folder, newest_ms, tmp_path):
    inbox = str(tmp_path / "in")
    write_files(comments, inbox)

    def run():
        return finish(
            jobs.top_articles(stream_of(spark, inbox), DAY, f"{tmp_path}/out", f"{tmp_path}/cp")
        )

    run()
    before = rows(spark.read.parquet(f"{tmp_path}/out"))
    # A copy of the first rows arrives after their window was closed.
    late = comments.orderBy("comment_id").limit(5)
    views.raw_lines(late, defects=False).select("value").coalesce(1).write.mode("append").text(inbox)
    query = run()
    dropped = sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
    assert dropped > 0
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == before


def test_top_users_equal_batch(spark, folder, tmp_path):
    jobs.use_disk_state(spark)
    try:
        finish(
            jobs.resolve_credits(
                stream_of(spark, folder),
                f"{tmp_path}/credits",
                f"{tmp_path}/cp1",
                salts=3,
            )
        )
        query = jobs.top_users(
            spark, f"{tmp_path}/credits", DAY, f"{tmp_path}/out", f"{tmp_path}/cp2"
        )
        finish(query)
    finally:
        for key in jobs.STATE_CONF:
            spark.conf.unset(key)

    batch = batch_of(spark, folder)
    from threadpulse.operators import threads
    from threadpulse.operators.filters import valid_users

    want_credits = threads.all_credits(valid_users(batch)).where("ts IS NOT NULL")
    got_credits = spark.read.schema(jobs.CREDITS_SCHEMA).parquet(f"{tmp_path}/credits")
    assert net(got_credits) == net(want_credits)

    newest = got_credits.agg(F.unix_millis(F.max("ts"))).first()[0] - DELAY_MS
    want = closed_only(top_users.top_users(batch, DAY), DAY, newest)
    assert want.count() > 100
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want)


def test_many_part_files_of_a_batch_lose_nothing(spark, comments, tmp_path):
    """Credits of one micro-batch in more files than any cap, in no event-time order."""
    from threadpulse.operators import threads
    from threadpulse.operators.filters import valid_users

    stored = threads.all_credits(valid_users(comments)).select("ts", "author", "cents", "level", F.lit(1).cast("bigint").alias("n"))
    stored.repartition(1100, F.rand(3)).write.parquet(f"{tmp_path}/credits")
    query = jobs.top_users(spark, f"{tmp_path}/credits", DAY, f"{tmp_path}/out", f"{tmp_path}/cp")
    finish(query)
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 0
    newest = stored.agg(F.unix_millis(F.max("ts"))).first()[0] - DELAY_MS
    want = closed_only(top_users.top_users(comments, DAY), DAY, newest)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want)


def test_old_and_redelivered_parent_gives_one_credit(spark, tmp_path):
    """The parent is 60 days older than its reply, and delivered twice at different times."""
    lines = [
        "1,aa,1,1,comment,1514764800,1,False,0,,4,S,u,10,X",
        "1,aa,1,1,comment,1514764830,1,False,0,,4,S,u,10,X",
        "1,aa,1,2,userReply,1519948800,2,False,1,,0,S,u,11,X",
    ]
    inbox = str(tmp_path / "in")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(inbox)
    finish(jobs.resolve_credits(stream_of(spark, inbox), f"{tmp_path}/credits", f"{tmp_path}/cp"))
    got = spark.read.schema(jobs.CREDITS_SCHEMA).parquet(f"{tmp_path}/credits")
    assert got.where("level = 1").count() == 1


def test_orphan_audit_equals_batch(spark, folder, tmp_path):
    from threadpulse.operators import threads
    from threadpulse.operators.filters import valid_users
    from threadpulse.streaming.threads import settled

    valid = valid_users(batch_of(spark, folder))
    want = threads.orphan_replies(valid)
    finish(jobs.audit_orphans(stream_of(spark, folder), f"{tmp_path}/lost", f"{tmp_path}/cp"))
    got = settled(spark.read.parquet(f"{tmp_path}/lost"))
    assert {r.depth for r in got.collect()} == {2, 3} and got.where("n <> 1").count() == 0
    assert rows(got.select("comment_id", "depth", "in_reply_to")) == rows(want)


def test_orphan_audit_within_a_horizon(spark, folder, tmp_path):
    from threadpulse.operators import threads
    from threadpulse.operators.filters import valid_users

    # The second join sees the watermark of the first, which lags by the horizon.
    valid = valid_users(batch_of(spark, folder))
    replies = valid.where("depth > 1")
    newest = replies.agg(F.unix_millis(F.max("ts"))).first()[0] - 3 * 86_400_000
    want = threads.orphan_replies(valid).join(replies.select("comment_id", "ts"), "comment_id")
    finish(jobs.audit_orphans(stream_of(spark, folder), f"{tmp_path}/lost", f"{tmp_path}/cp", horizon="2 days"))
    got = spark.read.schema("comment_id bigint, depth int, in_reply_to bigint, ts timestamp").parquet(f"{tmp_path}/lost")
    closed = F.unix_millis("ts") <= newest
    columns = ["comment_id", "depth", "in_reply_to"]
    assert got.join(want, "comment_id", "left_anti").count() == 0
    assert rows(got.where(closed).select(columns)) == rows(want.where(closed).select(columns))


def test_console_prints_every_window(spark, tmp_path, capsys):
    lines = [f"1,aa,1,{i},comment,{1514764800 + 3600 * i},1,False,0,,4,S,u,10,X" for i in range(1, 1103)]
    inbox = str(tmp_path / "in")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(inbox)
    from threadpulse.operators.windows import HOUR

    finish(jobs.top_articles(stream_of(spark, inbox), HOUR, "", f"{tmp_path}/cp", sink="console"))
    assert len(capsys.readouterr().out.strip().splitlines()) >= 1100


def test_short_horizon_bounds_history(spark, tmp_path):
    """A reply 3 days after its parent is credited only if the horizon reaches that far."""
    lines = [
        "1,aa,1,1,comment,1514764800,1,False,0,,4,S,u,10,X",
        "1,aa,1,2,userReply,1515024000,2,False,1,,0,S,u,11,X",
    ]
    inbox = str(tmp_path / "in")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(inbox)
    for horizon, level_one in (("1 day", 0), ("7 days", 1)):
        out = f"{tmp_path}/{level_one}"
        stream = credits(stream_of(spark, inbox), horizon=horizon)
        query = (
            stream.writeStream.outputMode("append")
            .option("checkpointLocation", f"{out}/cp")
            .trigger(availableNow=True)
            .format("parquet")
            .start(f"{out}/data")
        )
        finish(query)
        got = spark.read.schema(jobs.CREDITS_SCHEMA).parquet(f"{out}/data")
        assert got.where("level = 1").count() == level_one
        assert got.where("level = 0").count() == 1


def test_ranking_in_the_plan_equals_batch(spark, folder, newest_ms, tmp_path):
    """No ranking in foreachBatch, and at most a bucket's list per window in state."""
    from threadpulse.streaming import ranking

    try:
        query = finish(
            jobs.top_articles(stream_of(spark, folder), DAY, f"{tmp_path}/out", f"{tmp_path}/cp", rank="plan")
        )
        want = closed_only(top_articles.top_articles(batch_of(spark, folder), DAY), DAY, newest_ms)
        assert want.count() > 60
        assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want)
        # Operators are listed from the last to the first: merge, buckets, counts.
        kept = [[op.numRowsTotal for op in p.stateOperators] for p in query.recentProgress]
        assert all(len(k) == 3 for k in kept)
        windows = want.select("win_start_ms").distinct().count() + 2
        assert max(k[1] for k in kept) <= 2 * ranking.BUCKETS * windows  # a list and a timer each
    finally:
        for key in jobs.STATE_CONF:
            spark.conf.unset(key)


def test_ranking_in_the_plan_ties_nulls_and_few_keys(spark, tmp_path):
    from threadpulse.operators.ranking import top_k
    from threadpulse.operators.windows import HOUR, assign_window, label_window

    data = [(f"2018-01-01 0{h}:{m:02d}:00", key) for h in range(3) for m, key in enumerate(["b", "a", None, "b", "c", "a"][: 6 - 2 * h])]
    data += [("2018-01-02 00:00:00", "z"), ("2018-01-03 00:00:00", "z")]
    frame = spark.createDataFrame(data, "ts string, name string").withColumn("ts", F.to_timestamp("ts"))
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")

    def scored(df):
        return assign_window(df, HOUR).groupBy("window", "name").agg(F.count("*").alias("n"))

    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in").withWatermark("ts", "1 second")
    try:
        best = jobs.top_rows(scored(stream), HOUR, 2, "n", "name")
        writer = best.writeStream.option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True)
        finish(writer.format("parquet").start(f"{tmp_path}/out"))
    finally:
        for key in jobs.STATE_CONF:
            spark.conf.unset(key)
    want = top_k(label_window(scored(frame)), 2, "n", "name").where("win_start_ms < 1514937600000")
    assert repr(sorted(spark.read.parquet(f"{tmp_path}/out").collect(), key=repr)) == repr(sorted(want.collect(), key=repr))
    assert want.where("name IS NULL").count() == 1


COMMENT_LINE = "1,aa,1,{id},{kind},{ts},{depth},False,{parent},,4,S,u,{user},X"


def thread_lines(comments):
    kinds = {1: "comment", 2: "userReply", 3: "userReply"}
    return [COMMENT_LINE.format(id=i, depth=d, parent=p, user=u, ts=t, kind=kinds[d]) for i, d, p, u, t in comments]


def deliver(spark, batches, inbox):
    for lines in batches:
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(inbox)
        time.sleep(0.05)


def assert_threads_equal_batch(spark, batches, tmp_path, salts, restart=False):
    """Credits and orphans after all batches, delivered one file a trigger."""
    from threadpulse.operators import threads
    from threadpulse.operators.filters import valid_users
    from threadpulse.streaming.threads import settled

    inbox = f"{tmp_path}/in"
    steps = [batches[: len(batches) // 2], batches[len(batches) // 2 :]] if restart else [batches]
    for step in steps:
        deliver(spark, step, inbox)
        for start, out in ((jobs.resolve_credits, "credits"), (jobs.audit_orphans, "lost")):
            finish(start(stream_of(spark, inbox), f"{tmp_path}/{out}", f"{tmp_path}/cp-{out}", salts=salts))
    valid = valid_users(batch_of(spark, inbox))
    got = spark.read.schema(jobs.CREDITS_SCHEMA).parquet(f"{tmp_path}/credits")
    want = threads.all_credits(valid)
    assert net(got) == net(want)
    scores = lambda df: rows(df.selectExpr("unix_millis(window.start) AS start", "author", "cents"))
    assert scores(jobs.net_scores(got, DAY)) == scores(threads.score(want, DAY))
    lost = spark.read.schema("comment_id bigint, depth int, in_reply_to bigint, ts timestamp, n bigint").parquet(f"{tmp_path}/lost")
    orphan = ["comment_id", "depth", "in_reply_to"]
    want_lost = threads.orphan_replies(valid).groupBy(*orphan).agg(F.count("*").alias("n"))
    assert rows(settled(lost).groupBy(*orphan).agg(F.sum("n").alias("n"))) == rows(want_lost)
    return got


T = 1514764800


#: (id, depth, parent, user, time) by file, for each case; parents are among the ids of the case.
CASES = [
    # An id at depth 1 and 2, and a depth-3 reply to it.
    [[(1, 1, 0, 10, T), (5, 1, 0, 90, T)], [(1, 2, 5, 11, T + 9)], [(3, 3, 1, 12, T + 20)]],
    # The parent is delivered with a time after its reply, then with an earlier one.
    [[(1, 1, 0, 10, T + 100)], [(1, 1, 0, 10, T + 99)], [(2, 2, 1, 11, T + 99)]],
    # A second delivery names another author; the reply and a reply to it were credited before.
    [[(1, 1, 0, 10, T)], [(2, 2, 1, 11, T + 5), (3, 3, 2, 12, T + 6), (4, 3, 1, 13, T + 7)], [(1, 1, 0, 20, T + 1)]],
    # The chain comes in reverse.
    [[(3, 3, 2, 12, T + 6)], [(2, 2, 1, 11, T + 5)], [(1, 1, 0, 10, T)]],
    # A reply moves to another parent, and the old copy of a parent comes last.
    [[(1, 1, 0, 10, T), (6, 1, 0, 60, T), (2, 2, 1, 11, T + 5)], [(3, 3, 2, 12, T + 6), (2, 2, 6, 14, T + 8)], [(1, 1, 0, 9, T - 50)]],
]


def test_threads_in_any_order_equal_batch(spark, disk_state, tmp_path):
    files = [
        thread_lines((i + 100 * k, d, p + 100 * k if d > 1 else 0, u + 100 * k, t) for k, case in enumerate(CASES) for i, d, p, u, t in case[n])
        for n in range(3)
    ]
    got = assert_threads_equal_batch(spark, files, tmp_path, salts=2)
    of_case = {k: got.where(f"author div 100 = {k} AND level > 0") for k in range(len(CASES))}
    assert {r["author"] for r in of_case[0].collect()} == {11, 90}
    assert of_case[1].agg(F.sum("n")).first()[0] == 1
    assert of_case[2].where("n < 0").count() == 3 and rows(of_case[2].where("n > 0").select("author").distinct()) == [(210,), (211,), (220,)]


@pytest.mark.parametrize("salts", [1, 3])
def test_random_threads_equal_batch_after_a_restart(spark, disk_state, tmp_path, salts):
    import random

    rng = random.Random(salts)
    comments = []
    for i in range(250):
        depth = rng.choice([1, 2, 2, 3, 3])
        comments.append((rng.randint(1, 60), depth, rng.randint(0, 64), rng.randint(1, 9), T + rng.randint(0, 40) * 3600))
    batches = [thread_lines(comments[i::4]) for i in range(4)]
    got = assert_threads_equal_batch(spark, batches, tmp_path, salts, restart=True)
    assert got.where("n < 0").count() > 0


def test_a_stream_is_dealt_by_many_tasks_also_with_one_id(spark, disk_state, tmp_path):
    """Every trigger takes files that several tasks wrote; a NULL id in every row is no hot task."""
    from threadpulse.plans import kept

    ids = F.lit(None).cast("bigint")
    comments = spark.range(4000).select(ids.alias("comment_id"), "id", F.timestamp_seconds(F.col("id") + T).alias("ts"))
    for triggers in (1, 3):
        taken = []

        def start(source, out, checkpoint, taken=taken):
            def count(batch, _):
                taken.append((batch.count(), len(batch.inputFiles()), batch.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]))

            return source.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(count).start()

        kept._streamed(comments, triggers, start)
        assert sum(n for n, _, _ in taken) == 4000 and len(taken) == triggers
        assert all(largest < n / 4 for n, _, largest in taken)


def test_state_of_threads_is_kept_by_bucket(spark, disk_state, tmp_path):
    """The keys of state do not grow with the ids."""
    from threadpulse.streaming.threads import BUCKETS

    deliver(spark, [thread_lines([(i, 1, 0, i, T + i) for i in range(1, 3 * BUCKETS)])], f"{tmp_path}/in")
    query = finish(jobs.resolve_credits(stream_of(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp", salts=1))
    keys = max(max(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress)
    assert 0 < keys <= BUCKETS
