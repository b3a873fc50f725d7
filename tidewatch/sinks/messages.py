"""Post messages for a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.constants import POST_TOPIC
from tidewatch.functions.payload import message_json


def to_messages(posts: DataFrame, did: str = "did", created_at: str = "createdAt", text: str = "text") -> DataFrame:
    """A one-column ``value`` frame, ready for ``write`` or ``writeStream`` to a topic or a folder."""
    return posts.select(message_json(F.col(did), F.col(created_at), F.col(text)).alias("value"))


def publish(messages: DataFrame, target: str = POST_TOPIC, fmt: str = "kafka", **options: str) -> None:
    """Send a batch of messages to a topic, or append it to a folder of text files (``fmt="text"``)."""
    writer = messages.write.format(fmt).options(**options).mode("append")
    writer.option("topic", target).save() if fmt == "kafka" else writer.save(target)


def publish_stream(
    messages: DataFrame, checkpoint: str, target: str = POST_TOPIC, fmt: str = "kafka", trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """The same for a stream of messages."""
    writer = messages.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return writer.option("topic", target).start() if fmt == "kafka" else writer.start(target)
