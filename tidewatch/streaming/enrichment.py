"""Messages → enriched posts, laid out by day and hour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.times import Moment
from tidewatch.operators.clean import clean_messages
from tidewatch.schemas import BATCH, POST_DATE, POST_HOUR
from tidewatch.session import remove_matching, temporary_stages
from tidewatch.streaming.dedup import dedup


def run_enrichment(
    messages: DataFrame,
    enrich: Callable[[DataFrame], DataFrame] | None,
    target: str,
    checkpoint: str,
    as_of: Moment | None = None,
    trigger: dict | None = None,
    delay: str = "2 hours",
    **cleaning: object,
) -> StreamingQuery:
    """Clean and enrich every micro-batch and append it to the Parquet table at ``target``.

    A message that comes again within ``delay`` is dropped, so ``enrich`` sees posts that are unique by ``post_key``, and
    returns what is stored; ``None`` stores the cleaned posts, for a later batch load by that key. Rows lie in folders by
    day, hour and batch. What an interrupted attempt at a batch left is removed when the stream starts again,
    so a restart from ``checkpoint`` neither loses nor repeats posts.
    """
    started = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not started:  # later batches of this run are new
            remove_matching(spark, f"{target}/{POST_DATE}=*/{POST_HOUR}=*/{BATCH}={batch_id}")
            started.append(batch_id)
        with temporary_stages(spark):
            stored = batch if enrich is None else enrich(batch)
            if "post_uuid" not in stored.columns:
                stored = stored.withColumn("post_uuid", F.col("post_key"))
            laid_out = stored.withColumns({
                POST_DATE: F.to_date("created_at"), POST_HOUR: F.hour("created_at"), BATCH: F.lit(batch_id),
            })
            laid_out.write.mode("append").partitionBy(POST_DATE, POST_HOUR, BATCH).parquet(target)

    posts = dedup(clean_messages(messages, as_of, **cleaning), "post_key", "created_at", delay)
    writer = posts.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
