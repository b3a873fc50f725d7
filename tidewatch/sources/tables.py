"""Batch table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    isolation_level: str | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC scan. A big table needs ``partition_column`` with bounds, or one task reads it all."""
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("partition_column needs lower, upper and partitions")
        out |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    if isolation_level:
        out["isolationLevel"] = isolation_level
    return out


def read_table(
    spark: SparkSession, name: str, fmt: str = "parquet", schema: StructType | str | None = None, **options: str
) -> DataFrame:
    """A table by path (file formats), by options (``fmt="jdbc"``) or by catalog name (``fmt="table"``)."""
    if fmt == "table":
        return spark.read.options(**options).table(name)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load() if fmt == "jdbc" else reader.load(name)
