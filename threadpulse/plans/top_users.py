"""Most popular users per window: likes on their direct comments plus replies received."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.operators import threads
from threadpulse.operators.filters import valid_users
from threadpulse.operators.ranking import ranking_lines, top_k
from threadpulse.operators.windows import Span, label_window

TOP_USERS = 10


def like_scores(comments: DataFrame, span: Span) -> DataFrame:
    return label_window(threads.score(threads.like_credits(valid_users(comments)), span))


def reply_scores_by_level(comments: DataFrame, span: Span) -> DataFrame:
    credits = threads.reply_credits(valid_users(comments))
    return label_window(threads.score(credits, span, "level"))


def scores(comments: DataFrame, span: Span) -> DataFrame:
    credits = threads.all_credits(valid_users(comments))
    return label_window(threads.score(credits, span))


def ranking(scored: DataFrame, k: int = TOP_USERS) -> DataFrame:
    return top_k(scored, k, value="cents", key="author")


def top_users(comments: DataFrame, span: Span, k: int = TOP_USERS) -> DataFrame:
    return ranking(scores(comments, span), k)


def lines(ranked: DataFrame) -> DataFrame:
    return ranking_lines(ranked, "author", F.col("cents") / 100)
