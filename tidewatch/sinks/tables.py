"""Table sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.session import exists, remove_folder, stage, temporary_stages

# Where the merged partitions of an upsert wait below the table; readers skip names that begin like this.
PENDING = "_pending"
# Bytes of the staged rows that one writer, and so one file, takes.
WRITER_BYTES = 128 << 20


def append(df: DataFrame, target: str, fmt: str = "parquet", partition_by: Sequence[str] = (), **options: str) -> None:
    """Append to a path, a catalog table (``fmt="table"``) or a JDBC table (``fmt="jdbc"``, target ``dbtable``)."""
    writer = df.write.mode("append").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "table":
        writer.saveAsTable(target)
    elif fmt == "jdbc":
        writer.format("jdbc").option("dbtable", target).save()
    else:
        writer.format(fmt).save(target)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Store ``df`` as the catalog table ``name`` in ``buckets`` by hash of ``key``, one sorted file each, and read it back.

    Tables with the same key type and number of buckets are joined by that key, and grouped by it, without moving rows. Half a gigabyte
    a bucket is a good size. ``path`` puts the files there instead of the warehouse.
    """
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode(mode)
    (writer.option("path", path) if path else writer).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` put in place of rows with the same keys; other old rows stay.

    Keys are unique on both sides; a null in a key equals another null, so a re-run adds no second row.
    """
    replaced = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return old.join(replaced, same, "left_anti").unionByName(new)


def upsert_table(new: DataFrame, path: str, keys: Sequence[str], partition_by: str) -> None:
    """Upsert into a Parquet table laid out by ``partition_by``, rewriting only the partitions that ``new`` touches.

    The merged rows of those partitions are first written to ``<path>/_pending``, which readers of the table do not see. Spark
    then overwrites the partitions from that copy, and the copy goes when it has ended. A call that fails before the copy
    is whole changes nothing. One that fails later may leave some partitions old, new or gone; the copy is then still there, and
    the next call, or ``finish_upsert``, overwrites them again before anything else. ``partition_by`` is a function of the
    keys; its different values in ``new`` are collected. One writer at a time.
    """
    spark = new.sparkSession
    finish_upsert(spark, path, partition_by)
    with temporary_stages(spark):
        rows = stage(new, "upsert")
        parts = [r[0] for r in rows.select(partition_by).distinct().collect()]
        if not parts:
            return
        old = _partitions(spark, path, rows.schema, partition_by, parts)
        merged = rows if old is None else upsert(old, rows, keys)
        size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        replace_partitions(merged, path, partition_by, keys, -(-size // WRITER_BYTES) or 1)


def replace_partitions(rows: DataFrame, path: str, partition_by: str, keys: Sequence[str], writers: int = 1) -> None:
    """Put ``rows`` in place of all rows of the partitions they belong to, as safe from failures as ``upsert_table``.

    Rows go to writers by partition and by hash of ``keys``, so a hot partition has up to ``writers`` of them.
    """
    spark = rows.sparkSession
    finish_upsert(spark, path, partition_by)
    dealt = rows.repartition(F.col(partition_by), F.pmod(F.xxhash64(*keys), F.lit(writers)))
    dealt.sortWithinPartitions(partition_by).write.mode("overwrite").parquet(f"{path}/{PENDING}")
    finish_upsert(spark, path, partition_by)


def finish_upsert(spark: SparkSession, path: str, partition_by: str) -> None:
    """Overwrite partitions from the copy that an interrupted upsert left at ``path``, if there is one."""
    pending = f"{path}/{PENDING}"
    if exists(spark, f"{pending}/_SUCCESS"):
        _replace(spark.read.parquet(pending), path, partition_by)
    remove_folder(spark, pending)  # also one that was not written to its end


def _replace(rows: DataFrame, path: str, partition_by: str) -> None:
    """Spark's own partition overwrite: partitions without a row in ``rows`` stay as they are."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def existing(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table that ``upsert_table`` keeps at ``path``, or ``None`` where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _partitions(spark: SparkSession, path: str, schema: StructType, partition_by: str, parts: Sequence) -> DataFrame | None:
    """The rows of some partitions of the table at ``path``, or ``None`` where nothing was written yet."""
    table = existing(spark, path, schema)
    if table is None:
        return None
    known = F.col(partition_by).isin([p for p in parts if p is not None])
    return table.filter(known | F.col(partition_by).isNull() if None in parts else known).select(*schema.names)
