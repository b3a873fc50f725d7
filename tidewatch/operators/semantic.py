"""Keyphrases ranked by closeness of meaning to the whole post.

A word's base is a vector of signs taken from the bits of its MD5, of any length. Its vector is the sum of the bases of all words
of all posts that have the word, so words of like company point the same way. The sums are whole numbers: neither the
order of rows nor the number of tasks changes them, and nothing but rows of words is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.constants import STOP_WORDS
from tidewatch.functions.text import text_array
from tidewatch.operators.joins import lookup
from tidewatch.operators.keyphrases import lists, phrase_list, with_words
from tidewatch.session import stage

#: Length of the vectors.
SIZE = 32
#: Words of that length of vectors whose vectors go to every task.
LISTED = 50_000
#: Signs that are taken from one part of a hash, and such parts of a hash.
_SIGNS, _PARTS = 32, 4


def _bits(word: Column, block: int = 0) -> Column:
    """The signs of one block of 32 dimensions: a quarter of the word's MD5, and after four blocks of that of a longer word."""
    text = word if block < _PARTS else F.concat(word, F.lit(f" {block // _PARTS}"))
    return F.conv(F.substring(F.md5(text), 1 + 8 * (block % _PARTS), 8), 16, 10).cast("bigint")


def fit_word_vectors(
    df: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS, size: int = SIZE, min_count: int = 5,
    path: str | None = None,
) -> DataFrame:
    """``word, v`` of every word of at least ``min_count`` posts, written to shared storage; runs a job when called."""
    words = with_words(df.select(text), stop_words, text).select(F.array_distinct("_words").alias("_words"))
    blocks = range(-(-size // _SIGNS))

    def signs(block: int) -> Column:
        return F.transform("_words", lambda w: _bits(w, block))  # a second parameter would get the place in the array

    hashed = words.select("_words", *[signs(k).alias(f"_b{k}") for k in blocks])

    def dimension(i: int) -> Column:
        bits, at = f"_b{i // _SIGNS}", i % _SIGNS
        ones = F.aggregate(bits, F.lit(0).cast("bigint"), lambda s, b: s + F.shiftright(b, at).bitwiseAND(F.lit(1)))
        return F.size(bits) - 2 * ones

    company = hashed.select("_words", *[dimension(i).alias(f"v{i}") for i in range(size)])
    each = company.select(F.explode("_words").alias("word"), *[f"v{i}" for i in range(size)])
    sums = each.groupBy("word").agg(F.count("*").alias("_n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(size)])
    vector = F.array(*[F.col(f"v{i}").cast("double") for i in range(size)])
    return stage(sums.filter(F.col("_n") >= min_count).select("word", vector.alias("v")), "word-vectors", path)


def _scored(words: list[str], found: dict[str, int], table: np.ndarray, ngram: tuple[int, int], n: int) -> list[tuple[str, float | None]]:
    """The ``n`` phrases of a post closest to it: ``found`` has the row of ``table`` that is a word's vector."""
    phrases = list(dict.fromkeys(phrase_list(words, ngram)))
    at = [[found[w] for w in p.split(" ") if w in found] for p in phrases]
    kept = [i for i, rows in enumerate(at) if rows]
    if not kept:
        return []
    whole = table[[found[w] for w in words if w in found]].sum(axis=0)
    starts = np.cumsum([0] + [len(at[i]) for i in kept[:-1]])
    vectors = np.add.reduceat(table[[r for i in kept for r in at[i]]], starts, axis=0)
    dots, size = vectors @ whole, np.einsum("ij,ij->i", vectors, vectors) * (whole @ whole)
    scores = [round(d / math.sqrt(s), 6) if s > 0 else None for d, s in zip(dots.tolist(), size.tolist(), strict=True)]
    order = sorted(zip(scores, (phrases[i] for i in kept), strict=True), key=lambda x: (x[0] is None, -(x[0] or 0.0), x[1]))
    return [(p, x) for x, p in order[:n]]


def keywords_semantic(
    df: DataFrame, vectors: DataFrame, n: int = 3, key: str = "post_id", text: str = "text",
    ngram: tuple[int, int] = (1, 2), stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """``key, rank, keyword, score``: phrases by cosine between their vector and the post's, both sums over words.

    A phrase counts with the words that have vectors; phrases without any are left out. Vectors of up to LISTED words, those with
    the largest sums, which are the commonest, go to every task; the different rarer words of a post meet theirs once. Phrases are
    made and ranked inside the post's row. ``key`` must be unique. Runs jobs.
    """
    posts = with_words(df.select(key, text).filter(F.col(key).isNotNull()).repartition(key), stop_words, text).select(key, "_words")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.abs(x))
    size = vectors.select(F.size("v").alias("n")).first()
    most = LISTED * SIZE // max(SIZE, size["n"] if size else SIZE)
    top = stage(vectors.orderBy(F.desc(length), "word").limit(most), "common-vectors")
    listed = top.toArrow().combine_chunks()
    names = listed["word"].to_pylist()
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in listed["v"].chunks] or [np.zeros(0)])
    common = df.sparkSession.sparkContext.broadcast(({w: i for i, w in enumerate(names)}, flat.reshape(len(names), -1) if names else None))
    if len(names) < most:  # these are all
        whole = posts.select(key, "_words", text_array([]).alias("_k"), F.array().cast("array<double>").alias("_v"))
    else:
        used = posts.select(key, F.explode(F.array_distinct("_words")).alias("word"))
        rare = used.join(F.broadcast(top.select("word")), "word", "left_anti")
        known = lookup(rare, vectors, "word", "inner").groupBy(key).agg(F.collect_list(F.struct("word", "v")).alias("_known"))
        # The vectors of a post come as one array, in the order of their words.
        own = F.coalesce("_known.word", text_array([])).alias("_k")
        values = F.coalesce(F.flatten("_known.v"), F.array().cast("array<double>")).alias("_v")
        whole = posts.join(known, key, "left").select(key, "_words", own, values)
    rows = T.StructType([whole.schema[key], T.StructField("rank", T.IntegerType()), T.StructField("keyword", T.StringType()), T.StructField("score", T.DoubleType())])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ranks, names, scores = [], [], [], []
            each = zip(lists(batch.column(1)), lists(batch.column(2)), batch.column(3), strict=True)
            for i, (words, own, values) in enumerate(each):
                place, table = common.value
                near = [w for w in dict.fromkeys(words) if w in place]
                parts = [table[[place[w] for w in near]]] if near else []
                if own:
                    parts.append(values.values.to_numpy(zero_copy_only=False).reshape(len(own), -1))
                found = {w: r for r, w in enumerate(near + own)}
                best = _scored(words, found, np.concatenate(parts), ngram, n) if found else []
                at += [i] * len(best)
                ranks += range(1, len(best) + 1)
                names += [p for p, _ in best]
                scores += [x for _, x in best]
            keys = batch.column(0).take(pa.array(at, pa.int64()))
            columns = [keys, pa.array(ranks, pa.int32()), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [key, "rank", "keyword", "score"])

    return whole.mapInArrow(rank, rows)
