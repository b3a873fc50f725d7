"""Registration, and the SQL twins of the derived views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import session
from tidewatch.constants import POST_TYPE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The whole span of the events table, and a look-back inside it.
START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
AS_OF = "2024-01-08 00:07:00"

VIEWS = {
    "posts_base": """
        SELECT d.doc_id AS post_id, CAST(e.user_id AS VARCHAR) AS did, e.ts AS created_at, d.text,
               d.lang AS language
        FROM documents d JOIN events e ON e.event_id = d.doc_id""",
    "posts_wide": """
        SELECT event_id AS post_id, CAST(user_id AS VARCHAR) AS did, ts AS created_at,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'Positive'
                    WHEN event_type = 'error' THEN 'Negative' ELSE 'Neutral' END AS sentiment_label,
               value / (1 + value) AS sentiment_score,
               CASE event_id % 5 WHEN 0 THEN 'en' WHEN 1 THEN 'es' WHEN 2 THEN 'fr' WHEN 3 THEN 'de' END AS language,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 7 <> 0 END AS sfw,
               CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '[]'
                    ELSE '[["k' || json_extract_string(props, '$.k') || '", 0.5], ["' || event_type || '", 0.4]]'
               END AS keywords
        FROM events""",
    "keyword_rows": """
        SELECT post_id, created_at, sentiment_label, sentiment_score, kv[1] AS keyword
        FROM (SELECT post_id, created_at, sentiment_label, sentiment_score,
                     unnest(from_json(keywords, '[["VARCHAR"]]')) AS kv FROM posts_wide)
        WHERE length(kv[1]) <= 100""",
    "keyword_trends": """
        SELECT keyword, date_trunc('hour', created_at) AS period_start,
               date_trunc('hour', created_at) + INTERVAL 1 HOUR AS period_end,
               count(DISTINCT post_id) AS post_count, avg(sentiment_score) AS avg_sentiment_score, sentiment_label
        FROM keyword_rows GROUP BY ALL""",
    "messages": """
        SELECT post_id, did, text,
               CASE post_id % 3 WHEN 0 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ')
                    WHEN 1 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ')
                    ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') END AS createdAt
        FROM posts_base""",
    "raw_events": f"""
        SELECT post_id, CASE WHEN post_id % 20 <> 13 THEN did END AS did,
               post_id % 25 <> 24 AS has_record,
               CASE WHEN post_id % 10 = 9 THEN 'other.record' ELSE '{POST_TYPE}' END AS kind,
               createdAt, CASE WHEN post_id % 8 <> 7 THEN text END AS text
        FROM messages""",
    "parsed": """
        SELECT post_id, did, text, createdAt,
               coalesce(try_strptime(createdAt, '%Y-%m-%dT%H:%M:%S.%fZ'),
                        try_strptime(createdAt, '%Y-%m-%dT%H:%M:%SZ')) AS created_at
        FROM messages""",
}
NEEDS = {
    "keyword_rows": ("posts_wide",),
    "keyword_trends": ("keyword_rows",),
    "messages": ("posts_base",),
    "raw_events": ("messages",),
    "parsed": ("messages",),
}


def view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name], NEEDS[name] = sql, needs


def with_views(sql: str, *names: str) -> str:
    """``sql`` behind the common table expressions it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    sql = sql.strip()
    if not ctes:
        return sql
    # a query that begins with common table expressions of its own takes the views in front of them
    return f"WITH {ctes},\n{sql[4:].strip()}" if sql.upper().startswith("WITH") else f"WITH {ctes}\n{sql}"


def query(sql: str | None = None, *views: str):
    """Register a function under its own name, with its SQL twin where there is one."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session.configure(spark), sf_dir.rstrip("/"))

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = with_views(sql, *views)
        return fn

    return register


def micros(column: str | Column) -> Column:
    """A timestamp as text, so that both engines print it alike."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
