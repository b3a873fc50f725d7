"""Table, message and raw-feed sources."""

from tidewatch.sources.feed import select_posts
from tidewatch.sources.messages import read_message_stream
from tidewatch.sources.tables import read_table

__all__ = ["read_message_stream", "read_table", "select_posts"]
