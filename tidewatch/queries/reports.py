"""Dashboard and keyword reports."""

from pyspark.sql import functions as F

from tidewatch.constants import LANGUAGE_NAMES
from tidewatch.functions import times
from tidewatch.functions.times import in_range
from tidewatch.plans import reports, rollups
from tidewatch.queries.registry import AS_OF, END, START, query, sql_list, view, with_views
from tidewatch.queries.trends import hourly
from tidewatch.session import new_folder
from tidewatch.sources import views

WINDOW = f"created_at BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
# Reports on keywords are checked against the posts themselves: a post counts in the period of its hour.
PERIODS = f"date_trunc('hour', created_at) BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
SELECTED = ("click", "error", "purchase", "k1", "k42", "absent")

HOUR = "CAST(hour(created_at) AS INTEGER)"
FLAG = "CASE WHEN sfw THEN 'SFW' ELSE 'NSFW' END"

view(
    "dashboard",
    f"""WITH cells AS (SELECT {HOUR} AS h, sentiment_label AS l, {FLAG} AS f, coalesce(language, 'unknown') AS g
                      FROM posts_wide WHERE {WINDOW}),
             sums AS (SELECT grouping(h, l, f, g) AS summed, h, l, f, g, count(*) AS value
                      FROM cells GROUP BY GROUPING SETS ((h), (l), (h, l), (f), (g))),
             names(summed, metric) AS (VALUES (7, 'posts_by_hour'), (11, 'sentiment_totals'), (3, 'sentiment_by_hour'),
                                              (13, 'sfw_totals'), (14, 'language_totals')),
             facts(col2, value) AS (VALUES ('TOTAL_POSTS', (SELECT count(*) FROM events)),
                                           ('UNIQUE_USERS', (SELECT count(DISTINCT user_id) FROM events)),
                                           ('UNIQUE_KEYWORDS', (SELECT count(DISTINCT keyword) FROM keyword_rows)))
        SELECT metric, h AS col1, coalesce(l, f, g) AS col2, value FROM sums JOIN names USING (summed)
        UNION ALL BY NAME SELECT 'fast_facts' AS metric, col2, value FROM facts""",
    "posts_wide",
    "keyword_rows",
)


@query(
    f"""SELECT {HOUR} AS hour_of_day, count(*) AS num_posts FROM posts_wide
        WHERE created_at >= TIMESTAMP '{START}' AND created_at < TIMESTAMP '{END}' GROUP BY ALL""",
    "posts_wide",
)
def posts_by_hour(spark, sf):
    return reports.posts_by_hour(views.posts_wide(spark, sf), START, END)


@query(f"SELECT sentiment_label, count(*) AS num_posts FROM posts_wide WHERE {WINDOW} GROUP BY ALL", "posts_wide")
def sentiment_totals(spark, sf):
    return reports.sentiment_totals(views.posts_wide(spark, sf), START, END)


@query(
    f"""SELECT {HOUR} AS hour_of_day, sentiment_label, count(*) AS num_posts FROM posts_wide
        WHERE {WINDOW} GROUP BY ALL""",
    "posts_wide",
)
def sentiment_by_hour(spark, sf):
    return reports.sentiment_by_hour(views.posts_wide(spark, sf), START, END)


@query(f"SELECT {FLAG} AS sfw_flag, count(*) AS num_posts FROM posts_wide WHERE {WINDOW} GROUP BY ALL", "posts_wide")
def sfw_totals(spark, sf):
    return reports.sfw_totals(views.posts_wide(spark, sf), START, END)


LANGUAGES = f"""
    SELECT coalesce(language, 'unknown') AS language, count(*) AS num_posts
    FROM posts_wide WHERE {WINDOW} GROUP BY ALL"""


@query(LANGUAGES, "posts_wide")
def language_totals(spark, sf):
    return reports.language_totals(views.posts_wide(spark, sf), START, END)


NAME_CASES = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in LANGUAGE_NAMES.items())


@query(
    f"""SELECT language, num_posts, CASE language {NAME_CASES} ELSE language END AS language_name
        FROM ({LANGUAGES}) ORDER BY num_posts DESC, language LIMIT 3""",
    "posts_wide",
)
def top_languages(spark, sf):
    return reports.top_languages(views.posts_wide(spark, sf), START, END, k=3)


FACTS = """
    SELECT (SELECT count(*) FROM posts_wide) AS total_posts,
           (SELECT count(DISTINCT did) FROM posts_wide) AS unique_users,
           (SELECT count(DISTINCT keyword) FROM keyword_trends) AS unique_keywords"""


@query(FACTS, "posts_wide", "keyword_trends")
def fast_facts(spark, sf):
    return reports.fast_facts(views.posts_wide(spark, sf), hourly(spark, sf))


@query(
    f"SELECT true AS users_close, true AS keywords_close, total_posts FROM ({FACTS})", "posts_wide", "keyword_trends"
)
def fast_facts_approx(spark, sf):
    posts, trend = views.posts_wide(spark, sf), hourly(spark, sf)
    near = reports.fast_facts(posts, trend, exact=False).alias("a")
    exact = reports.fast_facts(posts, trend).alias("e")

    def close(column):
        return F.abs(F.col(f"a.{column}") / F.col(f"e.{column}") - 1) < 0.1

    return near.join(exact, F.col("a.total_posts") == F.col("e.total_posts")).select(
        close("unique_users").alias("users_close"), close("unique_keywords").alias("keywords_close"), "a.total_posts"
    )


@query("SELECT * FROM dashboard", "dashboard")
def dashboard_long(spark, sf):
    return reports.dashboard_long(views.posts_wide(spark, sf), hourly(spark, sf), START, END)


LOOKBACK = "TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-08 00:00:00'"


@query(with_views("SELECT * FROM dashboard", "dashboard").replace(WINDOW, f"created_at BETWEEN {LOOKBACK}"))
def dashboard_lookback(spark, sf):
    start, end = times.lookback(AS_OF)
    return reports.dashboard_long(views.posts_wide(spark, sf), hourly(spark, sf), start, end)


# A look-back with an edge at either end that is no whole hour.
EDGES = ("2024-01-04 13:22:31", "2024-01-09 07:41:05")
EDGED = f"created_at BETWEEN TIMESTAMP '{EDGES[0]}' AND TIMESTAMP '{EDGES[1]}'"


def _rolled(spark, sf):
    """Posts and their stored roll-ups."""
    folder = new_folder(spark, "rolled")
    posts = views.posts_wide(spark, sf)
    rollups.store_rollup(posts, folder, START, END)
    return posts, rollups.read_rollup(spark, folder)


@query(with_views("SELECT * FROM dashboard WHERE metric <> 'fast_facts'", "dashboard").replace(WINDOW, EDGED))
def dashboard_from_rollups(spark, sf):
    return rollups.dashboard_lookback(*_rolled(spark, sf), *EDGES)


@query(
    f"""SELECT count(*) AS num_posts, count(DISTINCT did) AS unique_users, true AS estimate_holds
        FROM posts_wide WHERE {EDGED}""",
    "posts_wide",
)
def distinct_users_from_sketches(spark, sf):
    """The estimate of stored sketches lies within four standard errors of the exact number."""
    posts, rolled = _rolled(spark, sf)
    estimate = rollups.distinct_users(posts, rolled, *EDGES).withColumnRenamed("unique_users", "estimate")
    exact = in_range(posts, "created_at", *EDGES, closed="both").agg(F.countDistinct("did").alias("unique_users"))
    error = 4 * rollups.SKETCH_ERROR * F.col("unique_users") + 0.5
    row = estimate.withColumn("unique_users", exact.scalar())
    return row.select("num_posts", "unique_users", (F.abs(F.col("estimate") - F.col("unique_users")) <= error).alias("estimate_holds"))


def _register_slices():
    for metric, columns in (
        ("posts_by_hour", "col1 AS hour_of_day, value AS num_posts"),
        ("sentiment_totals", "col2 AS sentiment_label, value AS num_posts"),
        ("sentiment_by_hour", "col1 AS hour_of_day, col2 AS sentiment_label, value AS num_posts"),
        ("sfw_totals", "col2 AS sfw_flag, value AS num_posts"),
        ("language_totals", "col2 AS language, value AS num_posts"),
        ("fast_facts", "col2 AS fact, value"),
    ):

        def run(spark, sf, metric=metric):
            return reports.slice_metric(dashboard_long(spark, sf), metric)

        run.__name__ = f"slice_{metric}"
        query(f"SELECT {columns} FROM dashboard WHERE metric = '{metric}'", "dashboard")(run)


_register_slices()

SUMS = f"""
    SELECT keyword, total_posts FROM (
        SELECT *, row_number() OVER (ORDER BY total_posts DESC, keyword) AS place
        FROM (SELECT keyword, count(DISTINCT post_id) AS total_posts FROM keyword_rows WHERE {PERIODS} GROUP BY keyword))
    WHERE place <="""


@query(f"{SUMS} 20", "keyword_rows")
def top_keywords(spark, sf):
    return reports.top_keywords(hourly(spark, sf), START, END)


@query(f"{SUMS} 20", "keyword_rows")
def top_keywords_ascending(spark, sf):
    return reports.top_keywords(hourly(spark, sf), START, END, order="asc")


@query(f"{SUMS} 80", "keyword_rows")
def keyword_choices(spark, sf):
    return reports.top_keywords(hourly(spark, sf), START, END, k=80)


@query(f"{SUMS} 20".replace(PERIODS, f"date_trunc('hour', created_at) BETWEEN {LOOKBACK}"), "keyword_rows")
def top_keywords_lookback(spark, sf):
    start, end = times.lookback(AS_OF)
    return reports.top_keywords(hourly(spark, sf), start, end)


BY_LABEL = f"""
    SELECT keyword, sentiment_label, count(DISTINCT post_id) AS n, round(avg(sentiment_score), 3) AS avg_score
    FROM keyword_rows WHERE {PERIODS} """


@query(f"{BY_LABEL} AND keyword IN ({sql_list(SELECTED)}) GROUP BY ALL", "keyword_rows")
def keyword_sentiment(spark, sf):
    return reports.keyword_sentiment(hourly(spark, sf), START, END, SELECTED)


@query(
    f"{BY_LABEL} AND keyword IN (SELECT event_type FROM events) GROUP BY ALL",
    "keyword_rows",
)
def keyword_sentiment_of_table(spark, sf):
    chosen = views.events(spark, sf).select(F.col("event_type").alias("keyword")).distinct()
    return reports.keyword_sentiment(hourly(spark, sf), START, END, chosen)


view(
    "keyword_stats",
    f"""SELECT keyword, count(*) AS total_posts, round(avg(score), 3) AS avg_sentiment_score,
               count(*) FILTER (label = 'Positive') AS positive, count(*) FILTER (label = 'Neutral') AS neutral,
               count(*) FILTER (label = 'Negative') AS negative
        FROM (SELECT post_id, keyword, any_value(sentiment_label) AS label, avg(sentiment_score) AS score
              FROM keyword_rows WHERE {PERIODS} GROUP BY post_id, keyword)
        WHERE keyword IN ({sql_list(SELECTED)}) GROUP BY keyword""",
    "keyword_rows",
)


@query("SELECT * FROM keyword_stats", "keyword_stats")
def keyword_stats(spark, sf):
    return reports.keyword_stats(hourly(spark, sf), START, END, SELECTED)


@query(
    """SELECT keyword, total_posts, positive, neutral, negative,
              round(positive / (positive + neutral + negative) * 100, 1) AS pct_positive,
              round(neutral / (positive + neutral + negative) * 100, 1) AS pct_neutral,
              round(negative / (positive + neutral + negative) * 100, 1) AS pct_negative
       FROM keyword_stats""",
    "keyword_stats",
)
def keyword_comparison(spark, sf):
    return reports.keyword_comparison(hourly(spark, sf), START, END, SELECTED)
