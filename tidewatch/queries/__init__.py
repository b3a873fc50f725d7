"""The registered queries, each with the SQL that has to give the same rows."""

from tidewatch.queries import cleaning, enrichment, incremental, reports, streams, trends
from tidewatch.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cleaning", "enrichment", "incremental", "reports", "streams", "trends"]
