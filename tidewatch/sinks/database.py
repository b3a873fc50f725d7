"""Upserts into a relational table, sent by the tasks that hold the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """``INSERT … ON DUPLICATE KEY UPDATE`` with ``%s`` placeholders; all columns but the keys are replaced."""
    names = ", ".join(columns)
    marks = ", ".join(["%s"] * len(columns))
    updates = ", ".join(f"{c} = VALUES({c})" for c in columns if c not in keys)
    return f"INSERT INTO {table} ({names}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {updates}"


def upsert_database(
    df: DataFrame, connect: Callable[[], Any], table: str, keys: Sequence[str], writers: int = 8, batch_size: int = 1_000
) -> None:
    """Upsert every row over ``writers`` connections, one transaction per ``batch_size`` rows.

    ``connect`` opens a DB-API connection and runs on the executors. A repeated task sends its rows
    again, which changes nothing. Keys are unique in ``df``.
    """
    sql = upsert_statement(table, df.columns, keys)

    def send(rows: Iterator[Row]) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            while batch := [tuple(r) for r in islice(rows, batch_size)]:
                cursor.executemany(sql, batch)
                connection.commit()
        finally:
            connection.close()

    df.repartition(writers, *keys).foreachPartition(send)
