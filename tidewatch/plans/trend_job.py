"""The hourly trend job: ``python -m tidewatch.plans.trend_job --start … --end … --posts … --trends …``.

With ``--late`` it first folds in the posts that a trend stream kept aside.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import session
from tidewatch.functions.times import Moment, moment
from tidewatch.operators.trends import keyword_trends
from tidewatch.schemas import POST_DATE, STREAMED_POSTS, TREND_KEY
from tidewatch.sinks.tables import upsert_table
from tidewatch.sources.tables import read_table

PARTITION = "period"
#: Names of folders by time: an hour each, for jobs and streams that touch a few hours at a time, or a day.
HOURLY, DAILY = "yyyy-MM-dd-HH", "yyyy-MM-dd"


def store_trends(trends: DataFrame, path: str, layout: str = HOURLY) -> None:
    """Upsert trend rows into the trend table, in folders by ``period_start``; a table keeps to one layout."""
    upsert_table(trends.withColumn(PARTITION, F.date_format("period_start", layout)), path, TREND_KEY, PARTITION)


def in_days(posts: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Leaves out the folders of other days, where the table is laid out by day."""
    if POST_DATE not in posts.columns:
        return posts
    return posts.filter(F.col(POST_DATE).between(F.to_date(moment(start)), F.to_date(moment(end))))


def run(posts: DataFrame, path: str, start: Moment, end: Moment) -> None:
    """Trends of ``[start, end)`` into the trend table; a re-run replaces its own rows.

    Posts are known by their id, or by their content key where a stream stored them, and may be repeated.
    """
    key = F.coalesce(F.col("post_id").cast("string"), F.col("post_uuid")) if "post_uuid" in posts.columns else F.col("post_id")
    known = in_days(posts, start, end).withColumn("post_id", key)
    store_trends(keyword_trends(known, start, end, unique_posts=False), path)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--start", required=True, help="first moment of the period, 'YYYY-MM-DD HH:MM:SS' in UTC")
    parser.add_argument("--end", required=True, help="first moment after the period")
    parser.add_argument("--posts", required=True, help="where the posts are")
    parser.add_argument("--trends", required=True, help="where the trend table is")
    parser.add_argument("--late", help="where a trend stream keeps late posts")
    args = parser.parse_args(argv)
    spark = session.build("keyword-trends")
    posts = read_table(spark, args.posts, schema=STREAMED_POSTS)
    if args.late:
        from tidewatch.streaming.late import fold_late

        fold_late(posts, args.late, args.trends)
    run(posts, args.trends, args.start, args.end)


if __name__ == "__main__":
    main()
