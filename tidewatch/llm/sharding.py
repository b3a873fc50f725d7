"""Sharding by weighted rendezvous hashing.

Each shard draws a number in (0, 1) for each key, from an MD5 of both; the shard with the largest
``-weight / ln(u)`` holds the key. A key's shard depends on the key and the shards alone, shares follow the
weights, and a new shard takes keys from the others into itself and moves no other key.

Slots number the rows of a shard from 0 without gaps. Rows are counted by shard and a bucket of the row's
hash; the counts before a bucket are its offset and rows are numbered inside buckets of some ``BUCKET_ROWS`` rows, so
no task holds a shard.

A null key is a key like another one; a null text counts as empty. Repeated keys lie in one shard, in slots of
their own by checksum and size. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
#: Rows numbered by one sort.
BUCKET_ROWS = 50_000
#: Hexadecimal digits of an MD5 that make a number exact in a double.
_DIGITS = 13


def draw(key: Column, shard: int) -> Column:
    """A number strictly between 0 and 1."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{shard}"))), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_DIGITS)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard that holds ``key``; equal scores go to the smaller number."""
    scores = [F.struct((-weight / F.log(draw(key, s))).alias("score"), F.lit(-s).alias("shard")) for s, weight in enumerate(weights)]
    return -F.array_max(F.array(*scores))["shard"]


def shard(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row ``key, size, text_crc32, law, shard, slot, grown_shard``; ``grown`` are the weights after growth."""
    grown = (*weights, 1.0) if grown is None else grown
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        key,
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
    buckets = max(1, -(-docs.count() // (BUCKET_ROWS * len(weights))))
    row = F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), "text_crc32", "size"))
    rows = rows.withColumn("bucket", F.pmod(F.conv(F.substring(row, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy(key, "text_crc32", "size")
    placed = rows.withColumn("nth", F.row_number().over(inside)).join(offsets, ["shard", "bucket"])
    return placed.select(
        key, "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"),
        (F.col("offset") + F.col("nth") - 1).alias("slot"), F.col("grown_shard").cast("int"),
    )
