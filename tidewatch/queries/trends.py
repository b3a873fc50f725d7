"""Keyword trends per period."""

from pyspark.sql import functions as F

from tidewatch.operators import trends
from tidewatch.plans import reports
from tidewatch.queries.registry import END, START, micros, query
from tidewatch.sources import views


def printable(df):
    return df.select(
        "keyword", micros("period_start").alias("period_start"), micros("period_end").alias("period_end"),
        "post_count", F.round("avg_sentiment_score", 6).alias("avg_sentiment_score"), "sentiment_label",
    )


def hourly(spark, sf):
    return trends.keyword_trends_hourly(views.posts_wide(spark, sf))


@query(
    f"""SELECT keyword, '{START}.000000' AS period_start, '{END}.000000' AS period_end,
               count(DISTINCT post_id) AS post_count, round(avg(sentiment_score), 6) AS avg_sentiment_score,
               sentiment_label
        FROM keyword_rows WHERE created_at >= TIMESTAMP '{START}' AND created_at < TIMESTAMP '{END}'
        GROUP BY keyword, sentiment_label""",
    "keyword_rows",
)
def keyword_trends(spark, sf):
    return printable(trends.keyword_trends(views.posts_wide(spark, sf), START, END))


@query(
    f"""SELECT keyword, '{START}.000000' AS period_start, '{END}.000000' AS period_end,
               count(DISTINCT post_id) AS post_count, round(avg(sentiment_score), 6) AS avg_sentiment_score,
               sentiment_label
        FROM (SELECT * FROM keyword_rows UNION ALL SELECT * FROM keyword_rows)
        WHERE created_at >= TIMESTAMP '{START}' AND created_at < TIMESTAMP '{END}'
        GROUP BY keyword, sentiment_label""",
    "keyword_rows",
)
def keyword_trends_repeated_posts(spark, sf):
    posts = views.posts_wide(spark, sf)
    return printable(trends.keyword_trends(posts.union(posts), START, END, unique_posts=False))


HOURLY_SQL = """
    SELECT keyword, strftime(period_start, '%Y-%m-%d %H:%M:%S.%f') AS period_start,
           strftime(period_end, '%Y-%m-%d %H:%M:%S.%f') AS period_end, post_count,
           round(avg_sentiment_score, 6) AS avg_sentiment_score, sentiment_label
    FROM keyword_trends"""


@query(HOURLY_SQL, "keyword_trends")
def keyword_trends_hourly(spark, sf):
    return printable(hourly(spark, sf))


@query(
    """SELECT min(name) AS keyword, strftime(period_start, '%Y-%m-%d %H:%M:%S.%f') AS period_start,
              strftime(period_end, '%Y-%m-%d %H:%M:%S.%f') AS period_end,
              CAST(sum(post_count) AS BIGINT) AS post_count,
              round(sum(avg_sentiment_score * post_count) / sum(post_count), 6) AS avg_sentiment_score,
              sentiment_label
       FROM (SELECT *, CASE WHEN hour(period_start) % 2 = 0 THEN replace(upper(keyword), 'E', 'É')
                            ELSE keyword END AS name FROM keyword_trends)
       GROUP BY lower(strip_accents(name)), period_start, period_end, sentiment_label""",
    "keyword_trends",
)
def keyword_trends_folded(spark, sf):
    spelt = F.when(
        F.hour("period_start") % 2 == 0, F.regexp_replace(F.upper("keyword"), "E", "É")
    ).otherwise(F.col("keyword"))
    return printable(trends.fold_keywords(hourly(spark, sf).withColumn("keyword", spelt)))


@query(
    """SELECT sentiment_label, count(*) AS num_posts FROM posts_wide
       GROUP BY sentiment_label""",
    "posts_wide",
)
def normalized_labels(spark, sf):
    shouted = views.posts_wide(spark, sf).withColumn(
        "sentiment_label", F.when(F.col("post_id") % 2 == 0, F.upper("sentiment_label")).otherwise(F.lower("sentiment_label"))
    )
    return reports.sentiment_totals(trends.normalize_labels(shouted), START, END)
