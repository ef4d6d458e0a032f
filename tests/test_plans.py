"""Physical plans: what may and may not appear, for every query."""

from __future__ import annotations

import pytest

from threadpulse.plans import catalogue as contract

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# A whole-table minimum and maximum end in one task by definition; each task
# sends one row. The row cap adds up its counts per hour or day, one row each.
ONE_TASK = {"time_span", "scan_limit", "scan_limit_days"}
# The last rows of the ranges (at most one per shuffle partition) are ordered in one task and broadcast.
RANGES = {"interarrival_gap", "interarrival_gap_article", "interarrival_gap_stream"}


@pytest.fixture(scope="module")
def big_joins(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_plan_is_distributed(big_joins, name):
    text = plan(contract.queries()[name](big_joins, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert bad not in text
    assert ("SinglePartition" in text) == (name in ONE_TASK | RANGES)
    assert ("BroadcastHashJoin" in text) == (name in RANGES)


@pytest.mark.parametrize("name", ["top3_articles_day", "top10_users_day"])
def test_ranking_limits_before_the_exchange(big_joins, name):
    text = plan(contract.queries()[name](big_joins, SF_DIR))
    assert "row_number(), 3, Partial" in text or "row_number(), 10, Partial" in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("top3_articles_day", "ts:timestamp_ntz,user_id:bigint,props:string"),
        ("slots_day_origin", "ts:timestamp_ntz,user_id:bigint,event_type:string"),
        ("latest_link", "event_id:bigint,ts:timestamp_ntz,user_id:bigint"),
        ("time_span", "ts:timestamp_ntz"),
    ],
)
def test_scan_reads_only_what_it_needs(spark, name, columns):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert f"ReadSchema: struct<{columns}>" in text
    if "user_id" in columns:
        assert "Not(EqualTo(user_id,0))" in text


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("top3_articles_day", 2),
        ("slots_day_origin", 1),
        ("slots_day_epoch", 2),
        ("latest_link", 1),
        ("ingest_valid", 0),
        ("ingest_reject_counts", 1),
        ("csv_repair", 0),
    ],
)
def test_number_of_exchanges(big_joins, name, exchanges):
    text = plan(contract.queries()[name](big_joins, SF_DIR))
    assert text.count("Exchange hashpartitioning") == exchanges


@pytest.fixture
def fixed_plans(big_joins):
    """Without adaptive execution a plan shows at once which exchanges are reused."""
    big_joins.conf.set("spark.sql.adaptive.enabled", "false")
    yield big_joins
    big_joins.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize(
    "name, scans, joins",
    [("reply_links", 2, 1), ("reply_credits_l1", 2, 1), ("orphan_replies", 4, 3), ("user_score_day", 5, 3)],
)
def test_scans_and_joins_of_replies(fixed_plans, name, scans, joins):
    """One join per depth of replies and kind of parent; the aggregate of the parents is exchanged once."""
    text = plan(contract.queries()[name](fixed_plans, SF_DIR))
    assert text.count("FileScan") == scans and text.count("SortMergeJoin") == joins


@pytest.mark.parametrize("name", ["reply_links", "orphan_replies", "user_score_day"])
def test_no_job_runs_while_a_reply_plan_is_built(spark, name):
    contract.queries()[name](spark, SF_DIR)
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", "building")
    try:
        contract.views.load_comments(spark, SF_DIR)
        reading = len(context.statusTracker().getJobIdsForGroup(f"build-{name}"))
        contract.queries()[name](spark, SF_DIR)
        assert len(context.statusTracker().getJobIdsForGroup(f"build-{name}")) == 2 * reading
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_both_sides_of_a_reply_join_come_from_an_exchange(big_joins):
    """So adaptive execution can part a hot parent; the union of both link sets is aggregated without another."""
    text = plan(contract.queries()["user_score_day"](big_joins, SF_DIR))
    assert text.count("SortMergeJoin") == text.count("Exchange hashpartitioning(link_id")
    assert "Exchange hashpartitioning(comment_id" in text
