"""Most commented articles per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.functions.time import processing_time
from threadpulse.operators.counts import article_counts
from threadpulse.operators.filters import valid_users
from threadpulse.operators.ranking import ranking_lines, top_k
from threadpulse.operators.windows import Span, label_window

TOP_ARTICLES = 3


def counts(comments: DataFrame, span: Span, audit: bool = False) -> DataFrame:
    """Comments per article and window; ``audit`` adds when the row was computed."""
    counted = label_window(article_counts(valid_users(comments), span))
    return counted.withColumn("processed_at", processing_time()) if audit else counted


def ranking(counted: DataFrame, k: int = TOP_ARTICLES) -> DataFrame:
    return top_k(counted, k, value="n", key="article_id")


def top_articles(comments: DataFrame, span: Span, k: int = TOP_ARTICLES) -> DataFrame:
    return ranking(counts(comments, span), k)


def lines(ranked: DataFrame) -> DataFrame:
    return ranking_lines(ranked, "article_id", F.col("n"))
