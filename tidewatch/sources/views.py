"""Post tables derived from the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.constants import CREATED_AT_PATTERNS, POST_TYPE
from tidewatch.functions.payload import message_json
from tidewatch.sources.tables import read_table

# The files hold zone-less microseconds; read as instants in UTC they can be pushed into the scan.
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
DOCUMENTS = "doc_id bigint, text string, lang string, source string"
LABELS = "doc_id bigint, quality int, toxic int"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/events.parquet", schema=EVENTS)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet", schema=DOCUMENTS)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table of fewer parts than there are cores, dealt to as many; a big one stays where it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def posts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text post per document, with author and time of the event of the same number."""
    who = events(spark, sf_dir).select(F.col("event_id").alias("doc_id"), "user_id", "ts")
    return (
        spread(documents(spark, sf_dir), "doc_id")
        .join(who, "doc_id")
        .select(
            F.col("doc_id").alias("post_id"),
            F.col("user_id").cast("string").alias("did"),
            F.col("ts").alias("created_at"),
            "text",
            F.col("lang").alias("language"),
        )
    )


def event_posts(ev: DataFrame) -> DataFrame:
    n = F.col("event_id")
    kind = F.col("event_type")
    names = F.concat(
        F.lit('[["k'), F.get_json_object("props", "$.k"), F.lit('", 0.5], ["'), kind, F.lit('", 0.4]]')
    )
    return ev.select(
        n.alias("post_id"),
        F.col("user_id").cast("string").alias("did"),
        F.col("ts").alias("created_at"),
        F.when(kind.isin("purchase", "signup"), "Positive")
        .when(kind == "error", "Negative")
        .otherwise("Neutral")
        .alias("sentiment_label"),
        (F.col("value") / (1 + F.col("value"))).alias("sentiment_score"),
        F.when(n % 5 == 0, "en").when(n % 5 == 1, "es").when(n % 5 == 2, "fr").when(n % 5 == 3, "de").alias("language"),
        F.when(n % 11 != 0, n % 7 != 0).alias("sfw"),
        F.when(n % 17 == 0, F.lit(None).cast("string")).when(n % 13 == 0, "[]").otherwise(names).alias("keywords"),
    )


def posts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One enriched post without text per event."""
    return event_posts(events(spark, sf_dir))


def created_at_text(ts: Column, n: Column) -> Column:
    """The same instant in one of the three accepted layouts."""
    return (
        F.when(n % 3 == 0, F.date_format(ts, CREATED_AT_PATTERNS[0]))
        .when(n % 3 == 1, F.date_format(ts, CREATED_AT_PATTERNS[1]))
        .otherwise(F.date_format(ts, CREATED_AT_PATTERNS[2]))
    )


def as_messages(posts: DataFrame, *keep: str) -> DataFrame:
    """``post_id`` and the post as a JSON message in ``value``, with the columns to ``keep``."""
    value = message_json(F.col("did"), created_at_text(F.col("created_at"), F.col("post_id")), F.col("text"))
    return posts.select("post_id", value.alias("value"), *keep)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(posts_base(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages wrapped as feed events, some of another type, some without a record, a text or an author."""
    n = F.col("post_id")
    post = F.from_json("value", "did string, createdAt string, text string")
    record = F.struct(
        F.when(n % 10 == 9, "other.record").otherwise(POST_TYPE).alias("$type"),
        post["createdAt"].alias("createdAt"),
        F.when(n % 8 != 7, post["text"]).alias("text"),
    )
    event = F.struct(
        F.when(n % 20 != 13, post["did"]).alias("did"),
        F.struct(F.when(n % 25 != 24, record).alias("record")).alias("commit"),
    )
    return messages(spark, sf_dir).select("post_id", F.to_json(event).alias("value"))
