"""Reply credits on a stream.

Without a horizon replies meet their parents in keyed state (``streaming.threads``): for good, in any order of
delivery, by the last copy of the parent, with what was credited wrongly taken back. With a ``horizon`` state is
bounded: replies meet parents written at most so long before them in stream-stream joins, each id has the link
delivered first, and nothing is taken back. Credits carry n, 1 or -1, which counts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.operators import threads
from threadpulse.operators.filters import at_depth, valid_users
from threadpulse.streaming import threads as keyed

DEFAULT_DELAY = "1 second"
DEFAULT_SALTS = 4


def _once(links: DataFrame) -> DataFrame:
    """One link per id, whatever the event times of its copies; the first delivered stays."""
    return links.dropDuplicates(["link_id"])


def _root_links(comments: DataFrame, delay: str) -> DataFrame:
    links = at_depth(comments, 1).select(
        F.col("comment_id").alias("link_id"),
        F.col("user_id").alias("link_user"),
        F.lit(None).cast("bigint").alias("root_user"),
        F.col("ts").alias("link_ts"),
    )
    return _once(links.withWatermark("link_ts", delay))


def _match(
    replies: DataFrame, links: DataFrame, horizon: str, salts: int, how: str = "inner"
) -> DataFrame:
    """Replies joined to their parent; ``salts`` spreads a hot parent over that many tasks.

    Each reply goes to one salt, each link to all of them.
    """
    replies = replies.withColumn("salt", F.pmod(F.xxhash64("comment_id"), F.lit(salts)))
    links = links.withColumn("link_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    bound = f"link_ts BETWEEN ts - INTERVAL {horizon} AND ts"
    return replies.join(links, F.expr(f"in_reply_to = link_id AND salt = link_salt AND {bound}"), how)


def _resolved(second: DataFrame, roots: DataFrame, horizon: str, salts: int) -> DataFrame:
    """Depth-2 replies under a known root, as links that depth-3 replies can name."""
    return _match(second, roots, horizon, salts).select(
        F.col("comment_id").alias("link_id"),
        F.col("user_id").alias("link_user"),
        F.col("link_user").alias("root_user"),
        F.col("ts").alias("link_ts"),
    )


def _bounded_credits(valid: DataFrame, horizon: str, delay: str, salts: int) -> DataFrame:
    roots = _root_links(valid, delay)
    second = at_depth(valid, 2).select("comment_id", "user_id", "in_reply_to", "ts")
    resolved = _resolved(second.withWatermark("ts", delay), roots, horizon, salts)
    first_level = threads.as_credits(
        resolved.selectExpr("link_ts AS ts", "root_user"), "root_user", level=1
    )

    third = at_depth(valid, 3).select("comment_id", "in_reply_to", "ts").withWatermark("ts", delay)
    known = _once(roots.unionByName(resolved))
    second_level = threads.credit_authors(
        _match(third, known, horizon, salts).select("ts", "link_user", "root_user")
    )
    return first_level.unionByName(second_level).withColumn("n", F.lit(1).cast("bigint"))


def credits(
    comments: DataFrame,
    horizon: str | None = None,
    delay: str = DEFAULT_DELAY,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Streaming counterpart of ``operators.threads.all_credits``, with n."""
    valid = valid_users(comments)
    if horizon:
        replies = _bounded_credits(valid, horizon, delay, salts)
    else:
        replies = keyed.reply_credits(valid, salts)
    likes = threads.like_credits(valid).withColumn("n", F.lit(1).cast("bigint"))
    return likes.unionByName(replies)


def orphan_replies(
    comments: DataFrame,
    horizon: str | None = None,
    delay: str = DEFAULT_DELAY,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Streaming counterpart of ``operators.threads.orphan_replies``, with event times and n.

    Without a horizon a reply is listed at once and taken back when its parent comes. With one it is listed
    when the watermark has passed its event time, as until then a parent that counts may still arrive.
    """
    valid = valid_users(comments)
    if not horizon:
        return keyed.orphan_changes(valid, salts)
    roots = _root_links(valid, delay)
    columns = ["comment_id", "depth", "user_id", "in_reply_to", "ts"]
    second = at_depth(valid, 2).select(columns).withWatermark("ts", delay)
    third = at_depth(valid, 3).select(columns).withWatermark("ts", delay)

    def lost(replies: DataFrame, links: DataFrame) -> DataFrame:
        matched = _match(replies, links, horizon, salts, "left_outer")
        return matched.where("link_id IS NULL").select("comment_id", "depth", "in_reply_to", "ts")

    known = _once(roots.unionByName(_resolved(second, roots, horizon, salts)))
    both = lost(second, roots).unionByName(lost(third, known))
    return both.withColumn("n", F.lit(1).cast("bigint"))
