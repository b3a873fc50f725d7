"""Joins with tables that have one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(big: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Add the columns of ``table`` (one row per ``key``) to the rows of ``big``, whose keys may be badly skewed.

    No hint and no test of size: the planner broadcasts what statistics show to be small, at run time too, and adaptive
    execution splits the tasks of hot keys on the side of ``big`` beyond that.
    """
    values = [c for c in table.columns if c != key]
    return big.join(table, key, how).select(*big.columns, *values)
