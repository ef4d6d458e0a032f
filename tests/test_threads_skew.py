"""Reply threads and gaps with hot keys and duplicates, against plain brute force."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from threadpulse.operators import profile, skew, threads
from threadpulse.schema import COMMENTS

START = datetime(2018, 1, 1, tzinfo=timezone.utc)


def make_rows(n: int, seed: int = 5):
    """Threads in which comment 1 is the parent of a third of all replies; some rows are copies."""
    rng = random.Random(seed)
    depth_of = {1: 1, 2: 2}
    rows = [(1, 500, 0, 1, 0, 3), (2, 501, 1, 2, 1, 0)]
    for cid in range(3, n):
        depth = rng.choice([1, 2, 3])
        wanted = 1 if depth == 2 else rng.choice([1, 2])
        pool = [i for i, d in depth_of.items() if d == wanted]
        parent = 0 if depth == 1 else (wanted if rng.random() < 0.4 else rng.choice(pool))
        if depth > 1 and rng.random() < 0.1:
            parent = -1
        rows.append((cid, rng.randrange(1, 40), cid * 60, depth, parent, rng.randrange(5)))
        depth_of[cid] = depth
    rows += [rng.choice(rows) for _ in range(n // 10)]
    # The first comment is sent again and again, last by another user.
    rows += [(1, 500, 0, 1, 0, 3)] * (n // 3) + [(1, 502, 30, 1, 0, 3)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows(400)


@pytest.fixture(scope="module")
def comments(spark, rows):
    data = [
        (c, u, START + timedelta(seconds=s), "a", "comment", d, p, likes, False)
        for c, u, s, d, p, likes in rows
    ]
    return spark.createDataFrame(data, COMMENTS).repartition(6).cache()


def expected(rows):
    last = {}
    for c, u, s, d, _, _ in rows:
        if d == 1:
            last[c] = max(last.get(c, (s, u)), (s, u))
    roots = {c: u for c, (_, u) in last.items()}
    resolved = [(c, u, roots[p]) for c, u, _, d, p, _ in rows if d == 2 and p in roots]
    second = {c: (u, r) for c, u, r in resolved}
    credits, orphans = Counter(), []
    for c, u, _, d, p, likes in rows:
        if d == 1:
            credits[u] += 30 * likes
        elif d == 2:
            if p in roots:
                credits[roots[p]] += 70
            else:
                orphans.append((c, d, p))
        elif p in roots:
            credits[roots[p]] += 70
        elif p in second:
            for author in second[p]:
                credits[author] += 70
        else:
            orphans.append((c, d, p))
    return roots, resolved, credits, orphans


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


# Adaptive execution as it comes, and with every partition above a kilobyte taken for skewed.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture(params=[{}, SMALL], ids=["as it comes", "skewed"])
def joins(spark, request):
    for key, value in request.param.items():
        spark.conf.set(key, value)
    yield bool(request.param)
    for key in request.param:
        spark.conf.unset(key)


def final_plan(df):
    """The rows, and the plan after adaptive execution."""
    found = tuples(df)
    return found, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_threads_equal_brute_force(joins, comments, rows):
    roots, resolved, credits, orphans = expected(rows)
    assert tuples(threads.latest_links(comments)) == sorted(roots.items())
    assert tuples(threads.reply_links(comments)) == sorted(resolved)
    assert tuples(threads.orphan_replies(comments)) == sorted(orphans)
    got = threads.all_credits(comments).groupBy("author").agg(F.sum("cents"))
    assert dict(map(tuple, got.collect())) == dict(credits)
    by_kind = threads.credits_under_replies(comments).unionByName(threads.credits_under_roots(comments))
    assert tuples(by_kind) == tuples(threads.reply_credits(comments).where("level = 2"))


@pytest.mark.parametrize("joins", [SMALL], indirect=True, ids=["skewed"])
def test_hot_parents_are_parted(spark, joins):
    """A third of all replies, many of them equal rows, hang under one root; adaptive execution parts them."""
    reply = "CASE WHEN id % 3 = 0 THEN 1 ELSE 6000 + id % 500 END"
    ids = spark.range(0, 60_000, 1, 12)
    roots = ids.where("id < 7000").selectExpr("id AS comment_id", "id + 1 AS user_id", "1 AS depth", "0L AS in_reply_to")
    second = ids.selectExpr("100000 + id % 40000 AS comment_id", "7L AS user_id", "2 AS depth", f"{reply} AS in_reply_to")
    third = ids.selectExpr("200000 + id AS comment_id", "8L AS user_id", "3 AS depth", f"{reply} AS in_reply_to")
    times = "TIMESTAMP '2018-01-01 00:00:00' AS ts"
    comments = roots.unionByName(second).unionByName(third).selectExpr("*", times)
    for build in (threads.reply_links, threads.credits_under_roots, threads.orphan_replies):
        _, plan = final_plan(build(comments))
        assert "SortMergeJoin(skew=true)" in plan


def test_link_records_round_trip(comments, rows):
    roots, resolved, _, _ = expected(rows)
    records = threads.link_records(comments)
    assert set(map(tuple, records.collect())) == {(str(c), str(u)) for c, u in roots.items()} | {
        (str(c), f"{u}_{r}") for c, u, r in resolved
    }
    back = threads.links_from_records(records)
    assert set(map(tuple, back.collect())) == {(c, u, None) for c, u in roots.items()} | set(resolved)


def test_null_parents_are_orphans(spark, joins):
    rows = [(i, 5, START, "a", "c", 2 + i % 2, None, 0, False) for i in range(10, 30)]
    df = spark.createDataFrame(rows + [(2, 5, START, "a", "c", 1, 0, 0, False)], COMMENTS)
    want = [(i, 2 + i % 2, None) for i in range(10, 30)]
    assert tuples(threads.orphan_replies(df)) == want
    assert threads.reply_links(df).count() == 0


@pytest.mark.parametrize("joins", [SMALL], indirect=True, ids=["skewed"])
def test_hot_and_null_keys_are_dealt_over_tasks(spark, joins):
    """Equal rows under one hot parent, and rows without a parent, part as well."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        children = spark.range(0, 8000, 1, 40).selectExpr("if(id % 2 = 0, 1, NULL) AS p", "repeat('x', 50) AS t")
        parents = spark.range(5).groupBy("id").count().selectExpr("id AS link_id", "count AS link_user")
        found = skew.lookup_join(children, parents, "p", "link_id")
        sizes = [len(part) for part in found.select("p").rdd.glom().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000
        lost = skew.lookup_join(children, parents, "p", "link_id", "left_anti")
        sizes = [len(part) for part in lost.select("p").rdd.glom().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def timed(spark):
    """One user has a third of all rows, many of them in the same second."""
    rng = random.Random(11)
    rows = []
    for cid in range(900):
        user = 7 if cid % 3 == 0 else rng.randrange(50, 90)
        second = 1000 if user == 7 and rng.random() < 0.7 else rng.randrange(5000)
        rows.append((cid, user, START + timedelta(seconds=second)))
    rows.append((900, None, START))
    return rows, spark.createDataFrame(rows, "comment_id long, user_id long, ts timestamp")


def brute_gaps(rows, keyed=True):
    out, last = {}, {}
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    for cid, user, ts in order:
        key = user if keyed else 0
        out[cid] = (ts - last[key]).total_seconds() if key in last else None
        last[key] = ts
    return out


@pytest.mark.parametrize("slices", [1, 3, 8])
def test_gaps_equal_brute_force(timed, slices):
    rows, df = timed
    got = profile.interarrival_gaps(df, "user_id", slices=slices)
    assert {r.comment_id: r.gap_seconds for r in got.collect()} == brute_gaps(rows)


@pytest.mark.parametrize("slices", [1, 7])
def test_gaps_of_the_whole_sequence(timed, slices):
    rows, df = timed
    got = profile.interarrival_gaps(df, None, slices=slices)
    assert {r.comment_id: r.gap_seconds for r in got.collect()} == brute_gaps(rows, keyed=False)


def test_large_null_group(timed, spark):
    """Comments without a user are a sequence of their own, cut like any other."""
    rows, _ = timed
    rows = [(c, None if c % 4 else u, ts) for c, u, ts in rows]
    df = spark.createDataFrame(rows, "comment_id long, user_id long, ts timestamp")
    got = profile.interarrival_gaps(df, "user_id", slices=8)
    assert {r.comment_id: r.gap_seconds for r in got.collect()} == brute_gaps(rows)


def test_group_of_copies_is_cut_too(spark):
    """Two thirds of the rows are copies of one row; no range may hold them all."""
    rows = [(5, 7, START)] * 600 + [(i, 7, START + timedelta(seconds=i - 300)) for i in range(10, 310)]
    df = spark.createDataFrame(rows, "comment_id long, user_id long, ts timestamp")
    got = profile.interarrival_gaps(df, "user_id", slices=9)
    gaps = Counter((r.comment_id, r.gap_seconds) for r in got.collect())
    want, previous = Counter(), None
    for cid, _, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        want[cid, (ts - previous).total_seconds() if previous else None] += 1
        previous = ts
    assert gaps == want
    ranged = df.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(
        9, "user_id", "ts", "comment_id", "copy"
    )
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 300


def test_an_id_at_two_depths_credits_its_last_author_once(spark):
    rows = [
        (1, 10, "2018-01-01 00:00:00", "comment", 1, 0, 0, False),
        (2, 11, "2018-01-01 00:01:00", "comment", 1, 0, 0, False),
        (1, 12, "2018-01-01 00:02:00", "userReply", 2, 2, 0, False),
        (5, 13, "2018-01-01 00:03:00", "userReply", 3, 1, 0, False),
    ]
    schema = (
        "comment_id long, user_id long, ts string, comment_type string, depth int, in_reply_to long, "
        "recommendations int, editors_selection boolean"
    )
    frame = spark.createDataFrame(rows, schema).selectExpr(
        *("CAST(ts AS TIMESTAMP) AS ts" if c == "ts" else c for c in schema.replace(",", "").split()[::2])
    )
    got = threads.all_credits(frame).where("level = 2").select("author").collect()
    assert sorted(r[0] for r in got) == [11, 12]
