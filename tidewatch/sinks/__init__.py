"""Append, upsert and message sinks."""

from tidewatch.sinks.database import upsert_database
from tidewatch.sinks.messages import publish, publish_stream, to_messages
from tidewatch.sinks.tables import append, replace_partitions, upsert, upsert_table, write_bucketed

__all__ = ["append", "publish", "publish_stream", "replace_partitions", "to_messages", "upsert", "upsert_database", "upsert_table", "write_bucketed"]
