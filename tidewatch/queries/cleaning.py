"""Intake: selection, parsing, time repair, keys, ranges, de-duplication."""

from pyspark.sql import functions as F

from tidewatch.constants import POST_TYPE
from tidewatch.functions import times
from tidewatch.operators import clean
from tidewatch.queries.registry import AS_OF, END, START, micros, query
from tidewatch.sinks import to_messages
from tidewatch.sources import select_posts, views

IS_POST = f"has_record AND kind = '{POST_TYPE}' AND did IS NOT NULL"
NOON = "2024-01-02 12:00:00"


@query(f"SELECT post_id, did, createdAt, coalesce(text, '') AS text FROM raw_events WHERE {IS_POST}", "raw_events")
def select_post_events(spark, sf):
    return select_posts(views.raw_events(spark, sf))[0]


@query(
    f"SELECT post_id, did, CASE WHEN has_record THEN kind END AS kind FROM raw_events WHERE NOT ({IS_POST})",
    "raw_events",
)
def reject_other_events(spark, sf):
    rejects = select_posts(views.raw_events(spark, sf))[1]
    return rejects.select(
        "post_id",
        F.get_json_object("value", "$.did").alias("did"),
        F.get_json_object("value", "$.commit.record['$type']").alias("kind"),
    )


@query(
    """SELECT json_extract_string(m, '$.did') AS did, json_extract_string(m, '$.createdAt') AS "createdAt",
              json_extract_string(m, '$.text') AS text
       FROM (SELECT json_object('did', did, 'createdAt', createdAt, 'text', text) AS m FROM messages)""",
    "messages",
)
def publish_messages(spark, sf):
    posts = views.posts_base(spark, sf)
    timed = posts.withColumn("createdAt", views.created_at_text(F.col("created_at"), F.col("post_id")))
    return to_messages(timed).select(
        *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("did", "createdAt", "text")]
    )


@query("SELECT post_id, did, createdAt, text FROM messages", "messages")
def parse_messages(spark, sf):
    return clean.parse_messages(views.messages(spark, sf))


@query(
    "SELECT post_id, did, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, text FROM parsed", "parsed"
)
def parse_created_at(spark, sf):
    parsed = clean.parse_created_at(clean.parse_messages(views.messages(spark, sf)))
    return parsed.withColumn("created_at", micros("created_at"))


@query(
    f"""SELECT post_id, strftime(CASE WHEN created_at BETWEEN TIMESTAMP '{NOON}' - INTERVAL 1 HOUR
                                         AND TIMESTAMP '{NOON}' THEN created_at ELSE TIMESTAMP '{NOON}' END,
                                 '%Y-%m-%d %H:%M:%S.%f') AS created_at
        FROM parsed""",
    "parsed",
)
def clamp_created_at(spark, sf):
    parsed = clean.parse_created_at(clean.parse_messages(views.messages(spark, sf)))
    return clean.clamp_created_at(parsed, NOON).select("post_id", micros("created_at").alias("created_at"))


@query(
    f"SELECT post_id, did, text FROM raw_events WHERE {IS_POST} AND coalesce(text, '') <> ''", "raw_events"
)
def drop_empty_posts(spark, sf):
    posts, _ = select_posts(views.raw_events(spark, sf))
    return clean.drop_empty(posts).select("post_id", "did", "text")


@query(
    "SELECT post_id, sha256(concat_ws(chr(1), did, createdAt, text)) AS post_key FROM messages", "messages"
)
def post_keys(spark, sf):
    return clean.with_post_key(clean.parse_messages(views.messages(spark, sf))).select("post_id", "post_key")


@query(
    f"""SELECT post_id, sha256(concat_ws(chr(1), did, createdAt, text)) AS post_key, did, text,
               strftime(CASE WHEN created_at BETWEEN TIMESTAMP '{NOON}' - INTERVAL 1 HOUR
                             AND TIMESTAMP '{NOON}' THEN created_at ELSE TIMESTAMP '{NOON}' END,
                        '%Y-%m-%d %H:%M:%S.%f') AS created_at
        FROM parsed WHERE text <> ''""",
    "parsed",
)
def clean_messages(spark, sf):
    cleaned = clean.clean_messages(views.messages(spark, sf), NOON)
    return cleaned.withColumn("created_at", micros("created_at"))


# The very moments of two events bound the ranges, so that open and closed ends differ.
FIRST, LAST = 100, 800
BOUNDS = [f"(SELECT created_at FROM posts_wide WHERE post_id = {n})" for n in (FIRST, LAST)]


def _bounds(spark, sf):
    rows = views.events(spark, sf).filter(F.col("event_id").isin(FIRST, LAST)).select(micros("ts")).collect()
    return sorted(r[0] for r in rows)


@query(
    f"SELECT post_id, did FROM posts_wide WHERE created_at >= least({BOUNDS[0]}, {BOUNDS[1]}) AND created_at < greatest({BOUNDS[0]}, {BOUNDS[1]})",
    "posts_wide",
)
def range_half_open(spark, sf):
    start, end = _bounds(spark, sf)
    return times.in_range(views.posts_wide(spark, sf), "created_at", start, end).select("post_id", "did")


@query(
    f"SELECT post_id, did FROM posts_wide WHERE created_at BETWEEN least({BOUNDS[0]}, {BOUNDS[1]}) AND greatest({BOUNDS[0]}, {BOUNDS[1]})",
    "posts_wide",
)
def range_closed(spark, sf):
    start, end = _bounds(spark, sf)
    return times.in_range(views.posts_wide(spark, sf), "created_at", start, end, "both").select("post_id", "did")


@query(
    """SELECT post_id, did, sentiment_label FROM posts_wide
       WHERE created_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-08 00:00:00'""",
    "posts_wide",
)
def range_lookback(spark, sf):
    start, end = times.lookback(AS_OF)
    rows = times.in_range(views.posts_wide(spark, sf), "created_at", start, end, "both")
    return rows.select("post_id", "did", "sentiment_label")


@query(
    """SELECT did, post_id, sentiment_label FROM
       (SELECT *, row_number() OVER (PARTITION BY did ORDER BY created_at DESC, post_id DESC) AS r FROM posts_wide)
       WHERE r = 1""",
    "posts_wide",
)
def latest_post_per_author(spark, sf):
    posts = views.posts_wide(spark, sf).select("did", "post_id", "created_at", "sentiment_label")
    return clean.dedup(posts, ["did"], ["created_at", "post_id"]).drop("created_at")


@query(
    """SELECT post_id, CAST(hour(created_at) AS INTEGER) AS hour_of_day,
              CAST(CASE WHEN hour(created_at) % 12 = 0 THEN 12 ELSE hour(created_at) % 12 END AS VARCHAR)
                || CASE WHEN hour(created_at) < 12 THEN ' AM' ELSE ' PM' END AS hour_label,
              strftime(to_timestamp(floor(epoch(created_at) / 900) * 900) AT TIME ZONE 'UTC',
                       '%Y-%m-%d %H:%M:%S') AS bucket,
              strftime(date_trunc('second', created_at + INTERVAL 500 MILLISECONDS),
                       '%Y-%m-%d %H:%M:%S') AS stored_at
       FROM posts_wide""",
    "posts_wide",
)
def time_functions(spark, sf):
    ts = F.col("created_at")
    return views.posts_wide(spark, sf).select(
        "post_id",
        F.hour(ts).alias("hour_of_day"),
        times.hour_label(F.hour(ts)).alias("hour_label"),
        times.timestamp_text(times.floor_minutes(ts)).alias("bucket"),
        times.timestamp_text(times.round_seconds(ts)).alias("stored_at"),
    )
