"""Selecting posts from a raw event feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.constants import POST_TYPE
from tidewatch.functions.payload import event_fields


def select_posts(raw: DataFrame, value: str = "value", post_type: str = POST_TYPE) -> tuple[DataFrame, DataFrame]:
    """``(posts, rejects)`` of a frame of raw JSON events, batch or streaming.

    Posts carry ``did, createdAt, text`` next to the other columns; a post without text has ``""``.
    Events of another type, without a record or without an author are rejected with their payload.
    """
    keep = [c for c in raw.columns if c != value]
    parsed = raw.select("*", event_fields(F.col(value)).alias("_event"))
    record = F.col("_event.commit.record")
    is_post = F.coalesce((record["$type"] == post_type) & F.col("_event.did").isNotNull(), F.lit(False))
    posts = parsed.filter(is_post).select(
        *keep,
        F.col("_event.did").alias("did"),
        record["createdAt"].alias("createdAt"),
        F.coalesce(record["text"], F.lit("")).alias("text"),
    )
    return posts, parsed.filter(~is_post).select(*keep, value)
