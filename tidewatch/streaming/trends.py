"""A trend table that follows a stream of enriched posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.trends import keyword_trends_hourly
from tidewatch.plans.trend_job import HOURLY, store_trends
from tidewatch.session import stage, temporary_stages
from tidewatch.streaming.dedup import dedup
from tidewatch.streaming.late import COLUMNS, keep_late


def stream_trends(posts: DataFrame, key: str = "post_id", delay: str = "2 hours", period: str = "1 hour") -> DataFrame:
    """Running trends of every open period. Each post is counted once, so no distinct aggregate is needed."""
    return keyword_trends_hourly(dedup(posts, key, "created_at", delay), period)


def run_trends(
    posts: DataFrame, path: str, checkpoint: str, key: str = "post_id", delay: str = "2 hours",
    period: str = "1 hour", trigger: dict | None = None, late: str | None = None,
    layout: str = HOURLY,
) -> StreamingQuery:
    """Upsert the trend rows that changed in a micro-batch into the table at ``path``.

    Posts older than ``delay`` are dropped by the stream. With ``late``, the table at that path takes them, for ``fold_late``;
    each micro-batch is then written once to the staging folder, and ``period`` is an hour.
    """
    changed = stream_trends(posts, key, delay, period)
    if late is not None:
        passed = posts.select(key, *COLUMNS).withColumn("_post", F.lit(True))
        changed = changed.withColumn("_post", F.lit(False)).unionByName(passed, allowMissingColumns=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        if late is None:
            store_trends(batch, path, layout)
            return
        with temporary_stages(batch.sparkSession):
            rows = stage(batch, "micro-batch")
            store_trends(rows.filter("NOT _post").drop("_post", key, *(c for c in COLUMNS if c != "sentiment_label")), path, layout)
            keep_late(rows.filter("_post").select(key, *COLUMNS), late, batch_id, delay)

    writer = changed.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()
