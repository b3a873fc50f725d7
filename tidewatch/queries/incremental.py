"""Incremental loads and upserts."""

import uuid

from pyspark.sql import functions as F

from tidewatch.functions.text import stored_keywords
from tidewatch.operators import clean, incremental, trends
from tidewatch.queries.registry import query, view
from tidewatch.queries.trends import HOURLY_SQL, hourly, printable
from tidewatch.schemas import TREND_KEY
from tidewatch.session import new_folder, stage
from tidewatch.sinks import upsert, write_bucketed
from tidewatch.sources import views

view("pairs", "SELECT DISTINCT post_id, keyword AS keyword_name FROM keyword_rows", "keyword_rows")
view(
    "dimension",
    """SELECT row_number() OVER (ORDER BY keyword_name) AS keyword_id, keyword_name
       FROM (SELECT DISTINCT keyword AS keyword_name FROM keyword_rows WHERE sentiment_label = 'Negative')""",
    "keyword_rows",
)
view(
    "new_names",
    """SELECT DISTINCT keyword_name FROM pairs
       WHERE keyword_name NOT IN (SELECT keyword_name FROM dimension)""",
    "pairs",
    "dimension",
)
view(
    "grown_dimension",
    """SELECT * FROM dimension UNION ALL
       SELECT (SELECT max(keyword_id) FROM dimension) + row_number() OVER (ORDER BY keyword_name), keyword_name
       FROM new_names""",
    "new_names",
)


def _named(spark, sf):
    """Posts with their keyword names as an array."""
    return views.posts_wide(spark, sf).withColumn("keywords", stored_keywords(F.col("keywords")))


def _pairs(spark, sf):
    return incremental.post_keyword_names(_named(spark, sf))


def _dimension(spark, sf):
    """The dimension as it stands when only negative posts were loaded."""
    seen = incremental.post_keyword_names(_named(spark, sf).filter(F.col("sentiment_label") == "Negative"))
    return incremental.assign_ids(seen.select("keyword_name").distinct(), "keyword_name", "keyword_id").select(
        "keyword_id", "keyword_name"
    )


@query(
    """SELECT post_id AS raw_post_id, did, text FROM posts_base
       WHERE post_id NOT IN (SELECT doc_id FROM labels)""",
    "posts_base",
)
def unprocessed_posts(spark, sf):
    raw = views.posts_base(spark, sf).select(F.col("post_id").alias("raw_post_id"), "did", "text")
    done = views.labels(spark, sf).select(F.col("doc_id").alias("raw_post_id"))
    return incremental.unprocessed(raw, done)


@query(
    """SELECT post_id, keyword_name, did FROM pairs JOIN (SELECT post_id, did FROM posts_wide WHERE post_id % 3 <> 0) USING (post_id)""",
    "pairs",
    "posts_wide",
)
def bucketed_tables(spark, sf):
    """Posts not loaded yet and their names, by an anti-join and a join of tables bucketed by the post's key."""
    name = f"tidewatch_{uuid.uuid4().hex}"

    def stored(df, what):
        return write_bucketed(df, f"{name}_{what}", "post_id", 8, new_folder(spark, f"bucketed-{what}"))

    posts = stored(views.posts_wide(spark, sf).select("post_id", "did"), "posts")
    done = stored(views.posts_wide(spark, sf).filter("post_id % 3 = 0").select("post_id"), "done")
    names = stored(_pairs(spark, sf), "names")
    fresh = incremental.unprocessed(posts, done, "post_id")
    return incremental.join_ids(names, fresh, "post_id").select("post_id", "keyword_name", "did")


@query("SELECT * FROM new_names", "new_names")
def new_keyword_names(spark, sf):
    return incremental.new_members(_dimension(spark, sf), _pairs(spark, sf))


@query("SELECT * FROM dimension", "dimension")
def keyword_dimension(spark, sf):
    return _dimension(spark, sf)


@query(
    "SELECT * FROM grown_dimension WHERE keyword_name IN (SELECT keyword_name FROM new_names)", "grown_dimension"
)
def extend_dimension(spark, sf):
    return incremental.extend_dimension(_dimension(spark, sf), _pairs(spark, sf))


@query(
    "SELECT DISTINCT post_id, keyword_id FROM pairs JOIN grown_dimension USING (keyword_name)",
    "pairs",
    "grown_dimension",
)
def build_bridge(spark, sf):
    dim, pairs = _dimension(spark, sf), _pairs(spark, sf)
    grown = stage(dim.unionByName(incremental.extend_dimension(dim, pairs)), "dimension")
    return incremental.build_bridge(pairs, grown)


@query("SELECT post_id, keyword_name FROM pairs", "pairs")
def post_keyword_names(spark, sf):
    return _pairs(spark, sf)


@query(
    """SELECT sha256(concat_ws(chr(1), did, createdAt, text)) AS post_uuid, CASE WHEN l.doc_id IS NOT NULL
              THEN post_id END AS post_id, did
       FROM messages m LEFT JOIN labels l ON l.doc_id = m.post_id""",
    "messages",
)
def lookup_post_ids(spark, sf):
    keyed = clean.with_post_key(clean.parse_messages(views.messages(spark, sf)), name="post_uuid")
    known = keyed.join(views.labels(spark, sf), F.col("post_id") == F.col("doc_id")).select("post_uuid", "post_id")
    return incremental.lookup_ids(keyed.select("post_uuid", "did"), known).select("post_uuid", "post_id", "did")


@query(
    """SELECT event_id + 1000000 AS stored_id, keyword
       FROM (SELECT DISTINCT post_id, keyword FROM keyword_rows) k JOIN events ON event_id = post_id
       WHERE event_type <> 'signup'""",
    "keyword_rows",
)
def join_id_map(spark, sf):
    """Enriched rows get the ids under which they were stored; signups were not."""
    stored = views.events(spark, sf).filter("event_type <> 'signup'")
    ids = stored.select(F.col("event_id").alias("post_id"), (F.col("event_id") + 1_000_000).alias("stored_id"))
    rows = _pairs(spark, sf).withColumnRenamed("keyword_name", "keyword")
    return incremental.join_ids(rows, ids, "post_id").select("stored_id", "keyword")


@query(
    """SELECT keyword, strftime(period_start, '%Y-%m-%d %H:%M:%S.%f') AS period_start,
              strftime(period_end, '%Y-%m-%d %H:%M:%S.%f') AS period_end,
              CASE WHEN hour(period_start) < 12 THEN post_count ELSE -1 END AS post_count,
              CASE WHEN hour(period_start) < 12 THEN round(avg_sentiment_score, 6) ELSE 0.0 END AS avg_sentiment_score,
              sentiment_label
       FROM keyword_trends""",
    "keyword_trends",
)
def upsert_trends(spark, sf):
    """A stale afternoon table takes the morning's rows: some replaced, some new, the vanished ones kept."""
    rows = hourly(spark, sf)
    stale = rows.filter(F.hour("period_start") >= 6).withColumns(
        {"post_count": F.lit(-1).cast("bigint"), "avg_sentiment_score": F.lit(0.0)}
    )
    fresh = rows.filter(F.hour("period_start") < 12)
    return printable(upsert(stale, fresh, TREND_KEY))


@query(HOURLY_SQL, "keyword_trends")
def rerun_trends(spark, sf):
    """Writing the same period twice changes nothing."""
    rows = hourly(spark, sf)
    return printable(upsert(upsert(rows, rows, TREND_KEY), rows, TREND_KEY))


@query(
    """SELECT DISTINCT keyword AS keyword_name, sentiment_label FROM keyword_rows""",
    "keyword_rows",
)
def distinct_keyword_labels(spark, sf):
    rows = trends.keyword_rows(views.posts_wide(spark, sf), "sentiment_label")
    return rows.select(F.col("keyword").alias("keyword_name"), "sentiment_label").distinct()
