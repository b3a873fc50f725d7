"""License scans with built-in functions only: MinHash bands over overlapping windows, then exact containment.

Words are runs of letters and digits in lower case, shingles are hashes of ``SIZE`` words. A template of m
different shingles is looked for in windows of 2M shingles, one from every M-th shingle on, where M is the power of two
that is not below m: wherever the template stands, a window holds all of it. A window has the template if it holds
at least ``CONTAINMENT`` of the template's shingles.

1. Inside each row, windows without any shingle of any template are left out by a table of bits (a literal; its false
   hits cost a window each). Nothing but the other windows leaves the row.
2. Each window has one MinHash value per band. The number of bands follows from the templates: a window that has one
   shares a band with it with a chance of at least ``CHANCE``.
3. Equal bands retrieve templates from a broadcast table (templates are a parameter, and bounded by ``MAX_SHINGLES``), and
   the window's shingles are held against the template's.

The report has a row per document id and license. Null and empty texts have no license; null ids are reported as one
null id; rows that share an id are one document. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE, CONTAINMENT, CHANCE = 5, 0.8, 0.9999
#: Bound on the shingles of all templates: the size of the literal and of the broadcast table.
MAX_SHINGLES = 100_000
#: Bits of the table for each shingle.
BITS = 1024

# The notices by which works name their licenses.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column, size: int = SIZE) -> Column:
    """Hashes of all ``size``-word shingles, in order."""
    n = F.size(words) - size
    each = F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))
    return F.when(n >= 0, each).otherwise(F.array().cast("array<bigint>"))


def _min_hashes(shingles: Column, bands: int) -> Column:
    """``(band, value)`` pairs."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*(F.struct(F.lit(b).alias("band"), least(b).alias("value")) for b in range(bands)))


def _templates(spark: SparkSession, notices: Sequence[tuple[str, str]], size: int) -> DataFrame:
    rows = spark.createDataFrame(list(enumerate(notices)), "template int, n struct<license: string, notice: string>")
    made = rows.select("template", "n.license", F.array_distinct(shingles(words(F.col("n.notice")), size)).alias("own"))
    m = F.size("own")
    return made.withColumn("need", F.ceil(m * CONTAINMENT)).withColumn(
        "step", F.pow(2.0, F.ceil(F.log2(F.greatest(m, F.lit(1))))).cast("int")
    )


def _table_of_bits(hashes: Sequence[int]) -> tuple[str, int]:
    """A literal array of words of bits, and the number of upper bits of a hash that pick one of them."""
    upper = max(6, math.ceil(math.log2(max(1, len(hashes)) * BITS)))
    table = [0] * (1 << (upper - 6))
    for h in hashes:
        at = (h & ((1 << 64) - 1)) >> (64 - upper)
        table[at >> 6] |= 1 << (at & 63)
    signed = (x - (1 << 64) if x >> 63 else x for x in table)
    return "array(" + ", ".join("CAST(-9223372036854775808 AS BIGINT)" if x == -(1 << 63) else f"{x}L" for x in signed) + ")", upper


def bands_needed(templates: Sequence[tuple[int, int, int]]) -> int:
    """Bands of one value for ``CHANCE``, given each template's ``shingles, need, step``."""
    least = min(need / (2 * step + m - need) for m, need, step in templates)
    return max(1, math.ceil(math.log(1 - CHANCE) / math.log(1 - least))) if least < 1 else 1


def scan(
    docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, key: str = "doc_id", text: str = "text", size: int = SIZE
) -> DataFrame:
    """``key, license, containment, first_word``: the licenses of each document that has any.

    ``containment`` is the largest share of a notice's shingles in one window and ``first_word`` the least place
    of a shingle of the window that holds one of the notice's.
    """
    spark = docs.sparkSession
    templates = _templates(spark, notices, size)
    rows = templates.collect()  # as many as there are notices
    if short := [notices[r["template"]] for r in rows if not r["own"]]:
        raise ValueError(f"notices need at least {size} words: {short}")
    known = sorted({h for r in rows for h in r["own"]})
    if len(known) > MAX_SHINGLES:
        raise ValueError(f"notices have over {MAX_SHINGLES} shingles; scan for them in several calls")
    literal, upper = _table_of_bits(known)
    bands = bands_needed([(len(r["own"]), r["need"], r["step"]) for r in rows])
    steps = sorted({r["step"] for r in rows})

    table = F.expr(literal)
    place = lambda h: F.shiftrightunsigned(h, 64 - upper)
    hit = lambda h: F.bit_get(F.get(table, F.shiftright(place(h), 6).cast("int")), place(h).bitwiseAND(F.lit(63)).cast("int")) == 1
    cut = docs.select(F.col(key).alias("id"), words(F.col(text)).alias("words"))
    cut = cut.select("id", shingles(F.col("words"), size).alias("own"))
    cut = cut.select("id", "own", F.array_compact(F.transform("own", lambda h, i: F.when(hit(h), i))).alias("hits"))
    spots = F.array_distinct(F.flatten(F.transform("hits", lambda p: F.flatten(F.array(*(
        F.array(F.struct(F.lit(s).alias("step"), F.floor(p / s).cast("int").alias("k")),
                F.struct(F.lit(s).alias("step"), F.greatest(F.floor(p / s).cast("int") - 1, F.lit(0)).alias("k")))
        for s in steps
    ))))))
    cut = cut.select("id", "own", spots.alias("spots"))
    part = lambda s: F.struct(s["step"].alias("step"), (s["k"] * s["step"]).alias("at"), F.slice("own", s["k"] * s["step"] + 1, s["step"] * 2).alias("part"))
    # explode_outer: a filter on what the arrays hold would be pushed below them and make them once more for each word
    seen = cut.select("id", F.explode_outer(F.transform("spots", part)).alias("w")).filter("w IS NOT NULL")
    seen = seen.select("id", "w.step", "w.at", "w.part").withColumn("b", F.explode_outer(_min_hashes(F.col("part"), bands)))

    own_bands = templates.select("template", "step", "license", "need", F.col("own").alias("theirs"), F.explode(_min_hashes(F.col("own"), bands)).alias("b"))
    found = seen.join(F.broadcast(own_bands), ["step", "b"])  # bounded by MAX_SHINGLES
    common = F.array_intersect("part", "theirs")
    found = found.withColumn("common", common).filter(F.size("common") >= F.col("need"))
    first = F.col("at") + F.array_min(F.transform("common", lambda h: F.array_position("part", h))) - 1
    return found.groupBy(F.col("id").alias(key), "license").agg(
        F.max(F.size("common") / F.size("theirs")).alias("containment"), F.min(first).cast("long").alias("first_word")
    )
