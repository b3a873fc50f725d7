"""Look-back reports from hourly roll-ups: whole hours are read as stored sums, only the two edges of a range as posts.

A roll-up row holds the posts of one hour that share label, flag and language: how many, and a mergeable sketch of their
authors. Both add up over any set of hours, so a range costs its hours and not its posts. Roll-ups are laid out by day, as an
hour has few rows; hours that are rolled up again replace what was stored of them. Posts laid out by day and hour, as the streams store them, are read from two
hours' folders.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import session
from tidewatch.functions.times import Moment, in_range, moment
from tidewatch.plans.reports import Bound, cell_columns, windowed_metrics
from tidewatch.schemas import POST_DATE, POST_HOUR, ROLLUPS, STREAMED_POSTS
from tidewatch.sinks.tables import finish_upsert, replace_partitions
from tidewatch.sources.tables import read_table

#: Logarithm of a sketch's registers, and its standard error for large sets.
SKETCH_BITS, SKETCH_ERROR = 12, 1.04 / 2**6
_PART, _DAY = "period_day", "yyyy-MM-dd"


def _sketch() -> Column:
    return F.hll_sketch_agg("did", F.lit(SKETCH_BITS))


def hourly_rollup(posts: DataFrame) -> DataFrame:
    """``period_start, label, flag, lang, n, users`` of every hour of ``posts``; posts without a time are in no hour."""
    hour = F.date_trunc("hour", "created_at").alias("period_start")
    return posts.filter(F.col("created_at").isNotNull()).groupBy(hour, *cell_columns()).agg(F.count("*").alias("n"), _sketch().alias("users"))


def store_rollup(posts: DataFrame, path: str, start: Moment, end: Moment) -> None:
    """Roll up the hours of ``[start, end)``, which begins and ends at full hours, into the table at ``path``.

    All that is stored of these hours is replaced. Only the days of the period are written.
    """
    spark = posts.sparkSession
    finish_upsert(spark, path, _PART)
    rolled = hourly_rollup(in_range(posts, "created_at", start, end)).withColumn(_PART, F.date_format("period_start", _DAY))
    with session.temporary_stages(spark):
        rows = session.stage(rolled, "rollup")
        if session.exists(spark, path):
            days = F.col(_PART).between(F.date_format(moment(start), _DAY), F.date_format(moment(end), _DAY))
            hour = F.col("period_start")
            others = read_rollup(spark, path).filter(days & ((hour < moment(start)) | (hour >= moment(end))))
            rows = rows.unionByName(others.select(*rows.columns))
        replace_partitions(rows, path, _PART, ("label", "flag", "lang"))


def read_rollup(spark, path: str) -> DataFrame:
    return spark.read.schema(ROLLUPS).parquet(path)


def segments(start: Bound, end: Bound) -> tuple[Column, Column, Column, Column]:
    """``start, first, last, end``: the closed range is whole hours from ``first`` up to ``last``, and what lies outside of them."""
    low, high = (b if isinstance(b, Column) else moment(b) for b in (start, end))
    floor = F.date_trunc("hour", low)
    first = F.when(floor == low, low).otherwise(floor + F.expr("INTERVAL 1 HOUR"))
    return low, first, F.date_trunc("hour", high), high


def edges(posts: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """Posts of the closed range that are in no whole hour of it: of one or two hours, by folder if posts are laid out so."""
    low, first, last, high = segments(start, end)
    at = F.col("created_at")
    rows = in_range(posts, "created_at", low, high, closed="both").filter((at < first) | (at >= last))
    if {POST_DATE, POST_HOUR} <= set(posts.columns):
        folder = [(F.col(POST_DATE) == F.to_date(m)) & (F.col(POST_HOUR) == F.hour(m)) for m in (low, high)]
        rows = rows.filter(folder[0] | folder[1])
    return rows


def whole_hours(rollup: DataFrame, start: Bound, end: Bound) -> DataFrame:
    _, first, last, _ = segments(start, end)
    hours = in_range(rollup, "period_start", first, last)
    if _PART in rollup.columns:  # folders are named by day, in order of time
        hours = hours.filter(F.col(_PART).between(F.date_format(first, _DAY), F.date_format(last, _DAY)))
    return hours


def lookback_cells(posts: DataFrame, rollup: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """``hour, label, flag, lang, n, users`` of a closed range, a cell having several rows."""
    columns = [F.hour("period_start").alias("hour"), "label", "flag", "lang", "n", "users"]
    return whole_hours(rollup, start, end).unionByName(hourly_rollup(edges(posts, start, end)), allowMissingColumns=True).select(*columns)


def dashboard_lookback(posts: DataFrame, rollup: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """The windowed metrics of ``reports.dashboard_long``; every whole hour of the range has been rolled up."""
    return windowed_metrics(lookback_cells(posts, rollup, start, end).drop("users"))


def distinct_users(posts: DataFrame, rollup: DataFrame, start: Bound, end: Bound) -> DataFrame:
    """``num_posts, unique_users``: all posts of a closed range, and an estimate of their different authors.

    Its standard error is ``SKETCH_ERROR`` for large numbers; small ones are as good as exact.
    """
    users = F.hll_sketch_estimate(F.hll_union_agg("users", F.lit(True)))
    return lookback_cells(posts, rollup, start, end).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_posts"), F.coalesce(users, F.lit(0)).alias("unique_users")
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="The hourly roll-up job.")
    parser.add_argument("--start", required=True, help="first hour, 'YYYY-MM-DD HH:00:00' in UTC")
    parser.add_argument("--end", required=True, help="first hour after the period")
    parser.add_argument("--posts", required=True, help="where the posts are")
    parser.add_argument("--rollups", required=True, help="where the roll-ups are")
    args = parser.parse_args(argv)
    spark = session.build("post-rollups")
    posts = read_table(spark, args.posts, schema=STREAMED_POSTS)
    days = F.col(POST_DATE).between(F.to_date(moment(args.start)), F.to_date(moment(args.end)))
    store_rollup(posts.filter(days), args.rollups, args.start, args.end)


if __name__ == "__main__":
    main()
