"""Raw feed events → post messages, and what was rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.constants import POST_TOPIC
from tidewatch.schemas import BATCH
from tidewatch.sinks.messages import publish, to_messages
from tidewatch.sources.feed import select_posts


def run_selection(
    events: DataFrame, rejects: str, checkpoint: str, target: str = POST_TOPIC, fmt: str = "kafka", trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Send the posts of every micro-batch on as messages and keep the other events at ``rejects``, a folder per batch.

    A batch that is done again replaces its rejects and may send its messages a second time; ``run_enrichment`` drops those.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        posts, others = select_posts(batch.select(F.col("value").cast("string").alias("value")))
        others.write.mode("overwrite").parquet(f"{rejects}/{BATCH}={batch_id}")
        publish(to_messages(posts), target, fmt, **options)

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
