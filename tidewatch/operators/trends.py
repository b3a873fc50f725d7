"""Keyword trends: posts per keyword, sentiment label and period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.constants import MAX_KEYWORD_LENGTH
from tidewatch.functions.text import counted, stored_keywords
from tidewatch.functions.times import Moment, in_range, moment

COLUMNS = ("keyword", "period_start", "period_end", "post_count", "avg_sentiment_score", "sentiment_label")


def keyword_rows(posts: DataFrame, *keep: str) -> DataFrame:
    """``keep…, keyword, n``: one row per post and distinct keyword, ``n`` being its occurrences in the post.

    Null, empty and malformed keyword text gives no row; neither do null names nor names over the limit.
    """
    # The names get a column of their own, or the JSON would be parsed again for every name.
    named = posts.select(*keep, stored_keywords(F.col("keywords")).alias("_names"))
    once = named.select(*keep, F.inline(counted(F.col("_names"))))
    return once.withColumnRenamed("name", "keyword").filter(F.length("keyword") <= MAX_KEYWORD_LENGTH)


def trend_measures(post: Column, score: Column, unique_posts: bool) -> list[Column]:
    """Distinct posts, and the mean score over every occurrence of the keyword."""
    n = F.col("n")
    posts = F.count("*") if unique_posts else F.countDistinct(post)
    mean = F.try_divide(F.sum(score * n), F.sum(F.when(score.isNotNull(), n)))
    return [posts.alias("post_count"), mean.alias("avg_sentiment_score")]


def keyword_trends(posts: DataFrame, start: Moment, end: Moment, unique_posts: bool = True) -> DataFrame:
    """Trends of one period ``[start, end)``.

    ``post_id`` is a key of ``posts``, so distinct posts are counted by counting the per-post rows: one
    shuffle of partial sums and no distinct aggregate. ``unique_posts=False`` counts distinct ids
    for tables that may repeat a post.
    """
    rows = keyword_rows(in_range(posts, "created_at", start, end), "post_id", "sentiment_label", "sentiment_score")
    return (
        rows.groupBy("keyword", "sentiment_label")
        .agg(*trend_measures(F.col("post_id"), F.col("sentiment_score"), unique_posts))
        .withColumn("period_start", moment(start))
        .withColumn("period_end", moment(end))
        .select(*COLUMNS)
    )


def keyword_trends_hourly(posts: DataFrame, period: str = "1 hour", unique_posts: bool = True) -> DataFrame:
    """Trends of every period of the input in one pass; a batch or a streaming frame."""
    rows = keyword_rows(posts, "post_id", "created_at", "sentiment_label", "sentiment_score")
    return (
        rows.groupBy(F.window("created_at", period).alias("w"), "keyword", "sentiment_label")
        .agg(*trend_measures(F.col("post_id"), F.col("sentiment_score"), unique_posts))
        .select("*", F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"))
        .select(*COLUMNS)
    )


def fold_keywords(trends: DataFrame) -> DataFrame:
    """Merge keywords that differ in case or accents only; the smallest spelling names the group.

    A store with a case- and accent-blind text comparison treats them as one key.
    """
    folded = F.collate(F.col("keyword"), "UNICODE_CI_AI")
    n, mean = F.col("post_count"), F.col("avg_sentiment_score")
    return (
        trends.groupBy(folded.alias("_k"), "period_start", "period_end", "sentiment_label")
        .agg(
            F.min("keyword").alias("keyword"),
            F.try_divide(F.sum(mean * n), F.sum(F.when(mean.isNotNull(), n))).alias("avg_sentiment_score"),
            F.sum("post_count").alias("post_count"),
        )
        .select(*COLUMNS)
    )


def normalize_labels(posts: DataFrame) -> DataFrame:
    """Sentiment labels in title case, whatever the scorer wrote."""
    return posts.withColumn("sentiment_label", F.initcap("sentiment_label"))
