"""Reply threads: who gets credit for which reply.

Depth-1 comments start a thread. A depth-2 reply credits the author of its
depth-1 parent. A depth-3 reply credits the author of its depth-2 parent and of
that parent's root; if it hangs directly under a depth-1 comment it credits that
author alone. A reply whose parent is unknown credits nobody.

Inputs are comments of valid users. A parent may have any share of all replies (see ``skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.functions.scores import LIKE_CENTS_SQL, REPLY_CENTS
from threadpulse.operators.filters import at_depth
from threadpulse.operators.skew import lookup_join
from threadpulse.operators.windows import Span, assign_window


def _timed_links(comments: DataFrame) -> DataFrame:
    return (
        at_depth(comments, 1)
        .groupBy("comment_id")
        .agg(F.expr("max(struct(ts, user_id)) AS last"))
        .selectExpr("comment_id AS link_id", "last.user_id AS link_user", "last.ts AS link_ts")
    )


def latest_links(comments: DataFrame) -> DataFrame:
    """Depth-1 comment -> author; of several copies the last one in event time wins."""
    return _timed_links(comments).drop("link_ts")


def _resolved_replies(comments: DataFrame, links: DataFrame) -> DataFrame:
    replies = at_depth(comments, 2).selectExpr("comment_id", "user_id", "in_reply_to", "ts")
    joined = lookup_join(replies, links, "in_reply_to", "link_id")
    return joined.selectExpr("comment_id", "user_id", "link_user AS root_user", "ts")


def reply_links(comments: DataFrame) -> DataFrame:
    """Depth-2 comment, its author and the author of the thread's root."""
    return _resolved_replies(comments, latest_links(comments)).drop("ts")


def _latest_reply_links(resolved: DataFrame) -> DataFrame:
    return (
        resolved.groupBy("comment_id")
        .agg(F.expr("max(struct(ts, user_id, root_user)) AS last"))
        .selectExpr(
            "comment_id AS link_id",
            "last.user_id AS link_user",
            "last.root_user AS root_user",
            "last.ts AS link_ts",
        )
    )


def _known_comments(links: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every comment a depth-3 reply can resolve to, once: of an id at two depths the last in event time.

    ``links`` carry ``link_ts``. Both sides are hash-partitioned by ``link_id`` already and stay so in the
    union, so the last aggregate needs no exchange; only the join to it does.
    """
    roots = links.selectExpr("link_id", "link_user", "CAST(NULL AS BIGINT) AS root_user", "link_ts")
    return (
        roots.unionByName(_latest_reply_links(resolved))
        .groupBy("link_id")
        .agg(F.expr("max(struct(link_ts, link_user, root_user)) AS last"))
        .selectExpr("link_id", "last.link_user AS link_user", "last.root_user AS root_user")
    )


def as_credits(df: DataFrame, author: str, level: int) -> DataFrame:
    return df.selectExpr(
        "ts", f"{author} AS author", f"{REPLY_CENTS} AS cents", f"{level} AS level"
    )


def _third_level(comments: DataFrame) -> DataFrame:
    return at_depth(comments, 3).selectExpr("in_reply_to", "ts")


def credit_authors(resolved: DataFrame) -> DataFrame:
    """Depth-3 replies joined to their parent -> one credit per known author."""
    authors = "explode(array(link_user, root_user)) AS author"
    known = resolved.selectExpr("ts", authors).where("author IS NOT NULL")
    return as_credits(known, "author", 2)


def link_records(comments: DataFrame) -> DataFrame:
    """Known comments as text records: ``user`` for a root, ``user_root`` for a reply to one."""
    links = _timed_links(comments)
    known = _known_comments(links, _resolved_replies(comments, links))
    return known.selectExpr(
        "CAST(link_id AS STRING) AS key", "concat_ws('_', link_user, root_user) AS value"
    )


def links_from_records(records: DataFrame) -> DataFrame:
    """Typed links back from their text records."""
    return records.selectExpr(
        "CAST(key AS BIGINT) AS link_id",
        "CAST(get(split(value, '_'), 0) AS BIGINT) AS link_user",
        "CAST(get(split(value, '_'), 1) AS BIGINT) AS root_user",
    )


def credits_under_replies(comments: DataFrame) -> DataFrame:
    """Only depth-3 replies to a depth-2 comment: two credits each."""
    parents = _latest_reply_links(_resolved_replies(comments, latest_links(comments)))
    replies = _third_level(comments)
    return credit_authors(lookup_join(replies, parents, "in_reply_to", "link_id"))


def credits_under_roots(comments: DataFrame) -> DataFrame:
    """Only depth-3 replies to a depth-1 comment: one credit each."""
    replies = _third_level(comments)
    joined = lookup_join(replies, latest_links(comments), "in_reply_to", "link_id")
    return as_credits(joined, "link_user", 2)


def like_credits(comments: DataFrame) -> DataFrame:
    return at_depth(comments, 1).selectExpr(
        "ts", "user_id AS author", f"{LIKE_CENTS_SQL} AS cents", "0 AS level"
    )


def reply_credits(comments: DataFrame) -> DataFrame:
    """Level 1: depth-2 replies. Level 2: depth-3 replies, whichever depth their parent has."""
    links = _timed_links(comments)
    resolved = _resolved_replies(comments, links)
    known = _known_comments(links, resolved)
    third = lookup_join(_third_level(comments), known, "in_reply_to", "link_id")
    return as_credits(resolved, "root_user", 1).unionByName(credit_authors(third))


def all_credits(comments: DataFrame) -> DataFrame:
    return like_credits(comments).unionByName(reply_credits(comments))


def orphan_replies(comments: DataFrame) -> DataFrame:
    """Replies that resolve to no known parent."""
    links = _timed_links(comments)
    known = _known_comments(links, _resolved_replies(comments, links))

    def lost(depth: int, parents: DataFrame) -> DataFrame:
        replies = at_depth(comments, depth).selectExpr("comment_id", "depth", "in_reply_to")
        return lookup_join(replies, parents, "in_reply_to", "link_id", "left_anti")

    return lost(2, links).unionByName(lost(3, known))


def score(credits: DataFrame, span: Span, *extra_keys: str) -> DataFrame:
    """Cents per window and author. Also runs on a stream with a watermark on ``ts``."""
    return (
        assign_window(credits, span)
        .groupBy("window", *extra_keys, "author")
        .agg(F.expr("sum(cents) AS cents"))
    )
