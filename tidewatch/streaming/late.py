"""Posts that come later than a trend stream's watermark: kept aside by the stream, folded into the trends by a later job.

A stream drops what is older than its watermark. ``run_trends`` with ``late`` sends every post two ways: into the running sums, and past
them to the end of the micro-batch, where those that may have been dropped are kept. What counts as late there is a mark of our own: the
latest time of all earlier micro-batches less the delay. Spark's watermark never lies beyond it, so every dropped post is kept,
and some that were counted as well, which is harmless: ``fold_late`` counts the hours of late posts anew from all posts by key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.times import Moment, in_range, moment
from tidewatch.operators.trends import keyword_trends_hourly
from tidewatch.plans.trend_job import HOURLY, in_days, store_trends
from tidewatch.schemas import BATCH

#: What trends need to know of a post, besides its key.
COLUMNS = ("created_at", "sentiment_label", "sentiment_score", "keywords")
_MARKS, _FOLDED = "_marks", "_folded"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def latest(spark: SparkSession, late: str, batch_id: int) -> datetime | None:
    """The latest time of a post in micro-batches up to ``batch_id``."""
    row = _read(spark, f"{late}/{_MARKS}/{BATCH}={batch_id}", "latest timestamp").first()
    return row and row["latest"]


def keep_late(posts: DataFrame, late: str, batch_id: int, delay: str) -> None:
    """Write the late posts of a micro-batch, and the mark for the next; a repeated batch replaces its own folders."""
    spark = posts.sparkSession
    before = latest(spark, late, batch_id - 1)
    if before is not None:
        behind = posts.filter(F.col("created_at") <= moment(before) - F.expr(f"INTERVAL {delay}"))
        behind.write.mode("overwrite").parquet(f"{late}/{BATCH}={batch_id}")
    now = posts.agg(F.greatest(F.max("created_at"), F.lit(before).cast("timestamp")).alias("latest"))
    now.coalesce(1).write.mode("overwrite").parquet(f"{late}/{_MARKS}/{BATCH}={batch_id}")


def settled_until(spark: SparkSession, late: str, delay: str = "2 hours") -> datetime | None:
    """Before this time the stream's sums change no more, but by posts that are kept aside too."""
    marks = _read(spark, f"{late}/{_MARKS}", f"latest timestamp, {BATCH} bigint")
    return marks.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("t")).first()["t"]


def fold_late(
    posts: DataFrame, late: str, trends: str, key: str = "post_id", delay: str = "2 hours", settled: Moment | None = None,
    layout: str = HOURLY,
) -> int:
    """Count anew the hours of late posts that were not folded in yet, and upsert them; the number of those hours.

    ``posts`` are all stored posts, which may lack the late ones. Hours that end after ``settled`` (what the stream's own
    mark says, by default) wait for a later call, as the stream may write them again. Folding twice changes nothing. The
    hours are collected; of ``posts`` only theirs are read, by folder where they are laid out by day.
    """
    spark = posts.sparkSession
    until = settled if settled is not None else settled_until(spark, late, delay)
    if until is None:
        return 0
    kinds = ", ".join(f"`{c}` {posts.schema[c].dataType.simpleString()}" for c in (key, *COLUMNS))
    side = _read(spark, late, f"{kinds}, {BATCH} bigint").withColumn("hour", F.date_trunc("hour", "created_at"))
    folded = _read(spark, f"{late}/{_FOLDED}", f"{BATCH} bigint, hour timestamp")
    ended = F.col("hour") + F.expr("INTERVAL 1 HOUR") <= moment(until)
    touched = side.filter(ended).select(BATCH, "hour").distinct().join(folded, [BATCH, "hour"], "left_anti").collect()
    hours = sorted({r["hour"] for r in touched})
    if not hours:
        return 0
    end = moment(hours[-1]) + F.expr("INTERVAL 1 HOUR")
    stored = in_range(in_days(posts, hours[0], hours[-1]), "created_at", moment(hours[0]), end)
    both = stored.select(key, *COLUMNS).unionByName(side.select(key, *COLUMNS))
    theirs = both.filter(F.date_trunc("hour", "created_at").isin(hours)).dropDuplicates([key])
    store_trends(keyword_trends_hourly(theirs.withColumnRenamed(key, "post_id")), trends, layout)
    spark.createDataFrame(touched, f"{BATCH} bigint, hour timestamp").coalesce(1).write.mode("append").parquet(f"{late}/{_FOLDED}")
    return len(hours)
