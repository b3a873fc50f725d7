"""Replays and double deliveries in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dedup(
    posts: DataFrame, key: str = "post_key", event_time: str = "created_at", delay: str = "2 hours"
) -> DataFrame:
    """One row per key as long as copies arrive within ``delay``; state older than that is dropped."""
    return posts.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
