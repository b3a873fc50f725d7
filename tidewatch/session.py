"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scope = threading.local()

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Texts go to Python in batches of some megabytes, however long they are.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # Staged text takes two thirds of the bytes that the default codec needs.
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffle files go when the job that wrote them ends, not when the driver next collects its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build(app_name: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; extra settings go in ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Start shuffles with enough partitions for ``input_bytes``; adaptive execution merges those that stay small.

    It never splits a partition for its size alone, so a fixed small number would spill on a big input.
    """
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without it; a cluster has to name a folder every executor can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tidewatch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; removed with the enclosing ``temporary_stages``, if there is one."""
    folder = f"{staging_root(spark)}/tidewatch/{label}-{uuid.uuid4().hex}"
    open_scope = getattr(_scope, "folders", None)
    if open_scope is not None:
        open_scope.append(folder)
    return folder


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Lineage ends at the written table, so a lost executor costs a re-read and not a re-run, several
    consumers share one computation, and file sizes give the planner true statistics for its joins.
    """
    path = path or new_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern of names matches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def remove_matching(spark: SparkSession, pattern: str) -> None:
    """Remove every folder that a pattern of names matches; none is fine."""
    for path in matching(spark, pattern):
        remove_folder(spark, path)


@contextmanager
def temporary_stages(spark: SparkSession):
    """Tables staged by this thread inside the block are removed when it ends.

    For work that is finished inside the block, such as the writing of a micro-batch.
    """
    outer, _scope.folders = getattr(_scope, "folders", None), []
    try:
        yield
    finally:
        for folder in _scope.folders:
            remove_folder(spark, folder)
        _scope.folders = outer
