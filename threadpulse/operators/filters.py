"""Row filters shared by the plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def valid_users(comments: DataFrame) -> DataFrame:
    """User 0 marks a row that ingest could not attribute."""
    return comments.where("user_id <> 0")


def direct_comments(comments: DataFrame) -> DataFrame:
    return valid_users(comments).where("contains(comment_type, 'comment')")


def at_depth(comments: DataFrame, depth: int) -> DataFrame:
    return comments.where(f"depth = {depth}")
