"""Report queries over ``posts`` and ``keyword_trends``; every function returns a small DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.constants import SENTIMENT_LABELS
from tidewatch.functions.text import language_name
from tidewatch.functions.times import Moment, in_range

Bound = Moment | Column


def _hour() -> Column:
    return F.hour("created_at")


def _sfw_flag() -> Column:
    """An unknown flag counts as NSFW."""
    return F.when(F.col("sfw"), "SFW").otherwise("NSFW")


def _language() -> Column:
    return F.coalesce(F.col("language"), F.lit("unknown"))


def _posts() -> Column:
    return F.count("*").alias("num_posts")


def _window(posts: DataFrame, start: Bound, end: Bound) -> DataFrame:
    return in_range(posts, "created_at", start, end, closed="both")


def posts_by_hour(posts: DataFrame, start: Bound, end: Bound, closed: str = "left") -> DataFrame:
    """Posts per hour of day; several days fold into 24 rows, hours without posts are absent."""
    rows = in_range(posts, "created_at", start, end, closed)
    return rows.groupBy(_hour().alias("hour_of_day")).agg(_posts()).orderBy("hour_of_day")


def sentiment_totals(posts: DataFrame, start: Bound, end: Bound) -> DataFrame:
    return _window(posts, start, end).groupBy("sentiment_label").agg(_posts())


def sentiment_by_hour(posts: DataFrame, start: Bound, end: Bound) -> DataFrame:
    rows = _window(posts, start, end).groupBy(_hour().alias("hour_of_day"), "sentiment_label").agg(_posts())
    return rows.orderBy("hour_of_day")


def sfw_totals(posts: DataFrame, start: Bound, end: Bound) -> DataFrame:
    return _window(posts, start, end).groupBy(_sfw_flag().alias("sfw_flag")).agg(_posts())


def language_totals(posts: DataFrame, start: Bound, end: Bound) -> DataFrame:
    rows = _window(posts, start, end).groupBy(_language().alias("language")).agg(_posts())
    return rows.orderBy(F.desc("num_posts"), "language")


def with_language_name(df: DataFrame, code: str = "language") -> DataFrame:
    return df.withColumn("language_name", language_name(F.col(code)))


def top_languages(posts: DataFrame, start: Bound, end: Bound, k: int = 15) -> DataFrame:
    return with_language_name(language_totals(posts, start, end).limit(k))


def fast_facts(posts: DataFrame, trends: DataFrame, exact: bool = True, rsd: float = 0.02) -> DataFrame:
    """One row of all-time totals. ``exact=False`` estimates the distinct counts within ``rsd``."""

    def distinct(column: str) -> Column:
        return F.countDistinct(column) if exact else F.approx_count_distinct(column, rsd)

    totals = posts.agg(F.count("*").alias("total_posts"), distinct("did").alias("unique_users"))
    return totals.withColumn("unique_keywords", trends.agg(distinct("keyword").alias("k")).scalar())


def cell_columns() -> list[Column]:
    """What the windowed metrics tell posts apart by, besides their hour."""
    return [F.col("sentiment_label").alias("label"), _sfw_flag().alias("flag"), _language().alias("lang")]


def cells(posts: DataFrame) -> DataFrame:
    """``hour, label, flag, lang, n``: posts by hour of day and the other columns of the windowed metrics."""
    return posts.groupBy(_hour().alias("hour"), *cell_columns()).agg(F.count("*").alias("n"))


def windowed_metrics(counted: DataFrame) -> DataFrame:
    """The five windowed metrics as grouping sets over cells; a cell may have several rows, which add up."""
    hour, label, flag, lang = (F.col(c) for c in ("hour", "label", "flag", "lang"))
    sets = counted.groupingSets([[hour], [label], [hour, label], [flag], [lang]], hour, label, flag, lang).agg(
        F.sum("n").alias("value"), F.grouping_id().alias("set")
    )
    # grouping_id has one bit per column, set where the column is summed over.
    metric = (
        F.when(F.col("set") == 0b0111, "posts_by_hour")
        .when(F.col("set") == 0b1011, "sentiment_totals")
        .when(F.col("set") == 0b0011, "sentiment_by_hour")
        .when(F.col("set") == 0b1101, "sfw_totals")
        .otherwise("language_totals")
    )
    return sets.select(metric.alias("metric"), hour.alias("col1"), F.coalesce(label, flag, lang).alias("col2"), "value")


def dashboard_long(
    posts: DataFrame, trends: DataFrame, start: Bound, end: Bound, exact: bool = True, rsd: float = 0.02
) -> DataFrame:
    """All home-page numbers as one ``metric, col1, col2, value`` table.

    The window is scanned once into counts per (hour, label, flag, language), a few thousand rows at
    any scale; the five windowed metrics are grouping sets over those.
    """
    windowed = windowed_metrics(cells(_window(posts, start, end)))
    facts = fast_facts(posts, trends, exact, rsd)
    names = ("total_posts", "unique_users", "unique_keywords")
    rows = F.inline(F.array(*[F.struct(F.lit(c.upper()).alias("col2"), F.col(c).alias("value")) for c in names]))
    all_time = facts.select(F.lit("fast_facts").alias("metric"), F.lit(None).cast("int").alias("col1"), rows)
    return windowed.unionByName(all_time)


# Metric → names of its columns in its own table.
SLICES = {
    "posts_by_hour": {"col1": "hour_of_day"},
    "sentiment_totals": {"col2": "sentiment_label"},
    "sentiment_by_hour": {"col1": "hour_of_day", "col2": "sentiment_label"},
    "sfw_totals": {"col2": "sfw_flag"},
    "language_totals": {"col2": "language"},
    "fast_facts": {"col2": "fact"},
}


def slice_metric(long: DataFrame, metric: str) -> DataFrame:
    """One metric of ``dashboard_long`` as a table of its own."""
    columns = [F.col(old).alias(new) for old, new in SLICES[metric].items()]
    value = F.col("value").alias("value" if metric == "fast_facts" else "num_posts")
    rows = long.filter(F.col("metric") == metric).select(*columns, value)
    return rows.orderBy(F.desc("num_posts"), "language") if metric == "language_totals" else rows


def weighted_mean(value: Column, weight: Column, digits: int = 3) -> Column:
    return F.round(F.try_divide(F.sum(value * weight), F.sum(weight)), digits)


def _periods(trends: DataFrame, start: Bound, end: Bound) -> DataFrame:
    return in_range(trends, "period_start", start, end, closed="both")


def _only(trends: DataFrame, keywords: Sequence[str] | DataFrame) -> DataFrame:
    if isinstance(keywords, DataFrame):
        return trends.join(keywords.select("keyword"), "keyword", "left_semi")
    return trends.filter(F.col("keyword").isin(list(keywords)))


def top_keywords(trends: DataFrame, start: Bound, end: Bound, k: int = 20, order: str = "desc") -> DataFrame:
    """The ``k`` keywords with most posts, ties by name; ``order="asc"`` lists the same rows smallest first."""
    sums = _periods(trends, start, end).groupBy("keyword").agg(F.sum("post_count").alias("total_posts"))
    top = sums.orderBy(F.desc("total_posts"), "keyword").limit(k)
    return top if order == "desc" else top.orderBy("total_posts", F.desc("keyword"))


def keyword_sentiment(
    trends: DataFrame, start: Bound, end: Bound, keywords: Sequence[str] | DataFrame
) -> DataFrame:
    rows = _only(_periods(trends, start, end), keywords)
    n, score = F.col("post_count"), F.col("avg_sentiment_score")
    return rows.groupBy("keyword", "sentiment_label").agg(
        F.sum(n).alias("n"), weighted_mean(score, n).alias("avg_score")
    )


def keyword_stats(trends: DataFrame, start: Bound, end: Bound, keywords: Sequence[str] | DataFrame) -> DataFrame:
    """Totals, weighted mean score and posts per sentiment, one row per keyword."""
    rows = _only(_periods(trends, start, end), keywords)
    n, score = F.col("post_count"), F.col("avg_sentiment_score")
    by_label = [
        F.sum(F.when(F.col("sentiment_label") == label, n).otherwise(0)).alias(label.lower())
        for label in SENTIMENT_LABELS
    ]
    return rows.groupBy("keyword").agg(
        F.sum(n).alias("total_posts"), weighted_mean(score, n).alias("avg_sentiment_score"), *by_label
    )


def keyword_comparison(trends: DataFrame, start: Bound, end: Bound, keywords: Sequence[str] | DataFrame) -> DataFrame:
    """``keyword_stats`` as shares of the three sentiments; null where a keyword has none of them."""
    names = [label.lower() for label in SENTIMENT_LABELS]
    whole = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    shares = [F.round(F.try_divide(F.col(c), whole) * 100, 1).alias(f"pct_{c}") for c in names]
    return keyword_stats(trends, start, end, keywords).select("keyword", "total_posts", *names, *shares)
