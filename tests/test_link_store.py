"""The lasting table of links and the record of late rows."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from threadpulse.operators import threads
from threadpulse.operators.filters import valid_users
from threadpulse.operators.windows import DAY
from threadpulse.sources import ingest, streams, views
from threadpulse.streaming import jobs, late_rows
from threadpulse.streaming.link_store import LinkStore, keep_links

SCHEMA = "comment_id bigint, depth int, in_reply_to bigint, user_id bigint, ts timestamp"
T = 1514764800


def frame(spark, comments):
    rows = spark.createDataFrame(comments, "comment_id bigint, depth int, in_reply_to bigint, user_id bigint, s bigint")
    return rows.select("comment_id", "depth", "in_reply_to", "user_id", F.timestamp_seconds("s").alias("ts"))


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def stream(spark, inbox):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(inbox)


def deliver(part, inbox):
    part.coalesce(1).write.mode("append").parquet(inbox)
    time.sleep(0.05)


def finish(query):
    query.awaitTermination(240)
    assert query.exception() is None
    return query


@pytest.mark.parametrize("every", [2, 1000])
def test_links_equal_batch_and_outlive_the_job(spark, tmp_path, every):
    comments = views.load_comments(spark, "/root/testdata/sf0.001").select(SCHEMA.replace(",", "").split()[::2])
    again = comments.where("comment_id % 7 = 0").withColumn("user_id", F.col("user_id") + 1000)
    again = again.withColumn("ts", F.expr("ts + make_interval(0, 0, 0, CAST(comment_id % 3 AS INT) - 1)"))
    inbox, path = f"{tmp_path}/in", f"{tmp_path}/links"
    everything = comments.unionByName(again)
    for i in range(3):
        deliver(everything.where(f"pmod(xxhash64(comment_id, user_id), 5) = {i}"), inbox)
    finish(keep_links(stream(spark, inbox), path, f"{tmp_path}/cp", every))
    for i in (3, 4):
        deliver(everything.where(f"pmod(xxhash64(comment_id, user_id), 5) = {i}"), inbox)
    finish(keep_links(stream(spark, inbox), path, f"{tmp_path}/cp", every))  # restarted

    valid = valid_users(everything)
    store = LinkStore(spark.newSession(), path)
    assert rows(store.links()) == rows(threads.latest_links(valid))
    assert rows(store.link_records()) == rows(threads.link_records(valid))
    assert store.links().where("link_user >= 1000").count() > 0
    ids = [1, 21, 42, 10**9]
    assert rows(store.read(ids)) == rows(store.read().where(F.col("comment_id").isin(ids)))
    # A second job from the beginning adds nothing new.
    finish(keep_links(stream(spark, inbox), path, f"{tmp_path}/cp2", every))
    assert rows(store.links()) == rows(threads.latest_links(valid))


def test_redelivered_comment_replaces_its_author(spark, tmp_path):
    store = LinkStore(spark, f"{tmp_path}/links", snapshot_every=2)
    assert store.read().count() == 0
    store.merge(frame(spark, [(1, 1, 0, 10, T), (2, 2, 1, 11, T + 5), (3, 3, 2, 12, T + 6), (9, 1, 0, 0, T)]), "q", 0)
    assert rows(store.links()) == [(1, 10)]
    store.merge(frame(spark, [(1, 1, 0, 20, T + 1)]), "q", 1)
    store.merge(frame(spark, [(1, 1, 0, 30, T - 1)]), "q", 2)
    assert rows(store.links()) == [(1, 20)]
    assert rows(store.link_records()) == [("1", "20"), ("2", "11_20")]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """Also when the first attempt wrote its delta or its snapshot and was lost before it was done."""
    store = LinkStore(spark, f"{tmp_path}/links", snapshot_every=2)
    batches = [frame(spark, [(i, 1, 0, 10 + i, T + i), (1, 1, 0, 50 + i, T + i)]) for i in range(5)]
    for i, batch in enumerate(batches):
        store.merge(batch, "q", i)
        before = rows(store.read())
        store.merge(batch, "q", i)
        assert rows(store.read()) == before
    store._remove("list/0000000001/_SUCCESS")  # the second snapshot was never listed
    assert rows(store.read()) == before
    store.snapshot()
    assert rows(store.read()) == before
    assert len(before) == 5 and (1, 1, None, 54) in [(r[0], r[1], r[2], r[4]) for r in before]


def test_snapshots_replace_what_they_hold(spark, tmp_path):
    store = LinkStore(spark, f"{tmp_path}/links", snapshot_every=1)
    for i in range(4):
        store.merge(frame(spark, [(i, 1, 0, i + 1, T)]), "q", i)
    assert store.read().count() == 4
    assert len(store._folders("snapshot")) == 2 and len(store._folders("delta/q")) == 1
    plan = store.read([2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_one_late_row_is_recorded(spark, tmp_path):
    def line(i, seconds):
        return f"1,aa,1,{i},comment,{seconds},1,False,0,,4,S,u,10,X"

    inbox, table = f"{tmp_path}/in", f"{tmp_path}/late"
    # A step drops by the watermark that the trigger before it began with.
    later = T + 3 * 86400
    for lines in ([line(1, T), line(2, later)], [line(3, later + 1)], [line(4, T + 60), line(5, later + 5)]):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(inbox)
        time.sleep(0.05)
    listener = late_rows.record_late_rows(spark, table)
    try:
        parsed = ingest.parse_lines(streams.lines_from_folder(spark, inbox, max_files=1), arrival="timestamp")
        query = finish(jobs.top_articles(ingest.valid_comments(parsed), DAY, f"{tmp_path}/out", f"{tmp_path}/cp"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(50):  # the listener runs beside the query
            try:
                found = late_rows.read_late_rows(spark, table).collect()
                break
            except Exception:
                time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert [(r["query"], r["operator"], r["step"], r["dropped"]) for r in found] == [(str(query.id), "stateStoreSave", 0, 1)]
    total = late_rows.totals(late_rows.read_late_rows(spark, table)).collect()
    assert [(r["query"], r["dropped"]) for r in total] == [(str(query.id), 1)]
