"""Structured Streaming runs of the intake and of the trend table."""

from tidewatch.streaming.dedup import dedup
from tidewatch.streaming.enrichment import run_enrichment
from tidewatch.streaming.late import fold_late
from tidewatch.streaming.selection import run_selection
from tidewatch.streaming.trends import run_trends

__all__ = ["dedup", "fold_late", "run_enrichment", "run_selection", "run_trends"]
