"""Periodic runs against plain loops over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import LONG, prose

from tidewatch.llm import periods
from tidewatch.llm import words as W


def plain_runs(words):
    """Every stretch of equal words q apart, in order of q, so the first of one stretch has its smallest period."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def hashed(docs):
    rows = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    return W.mix(np.array([x for d in docs for x in d], np.uint64) + np.uint64(9)), rows


def check(docs):
    want = [(r, *x) for r, d in enumerate(docs) for x in plain_runs(d)]
    assert [tuple(x) for x in periods.runs(*hashed(docs)).tolist()] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 160), st.sampled_from([1, 2, 2, 3, 6, 60]), st.integers(0, 3), st.integers()), max_size=4))
def test_runs_of_random_rows(plans):
    docs = []
    for n, letters, tails, seed in plans:
        draw = random.Random(seed)
        words = [draw.randrange(letters) for _ in range(n)]
        for _ in range(tails if n else 0):
            a = draw.randrange(n)
            q = draw.randint(1, max(1, (n - a) // 3))
            words[a:] = [words[a + (i - a) % q] for i in range(a, n)]
        docs.append(words)
    check(docs)


@pytest.mark.parametrize(
    "words",
    [
        [0] * 23, [0] * 24, [0, 1] * 12, [0, 1] * 11 + [0], list(range(9)) * 3, list(range(9)) * 3 + [0, 1],
        ([0] * 30 + [1]) * 4, ([0, 1] * 15 + [2]) * 3 + [0, 1, 0], [0] * 300, (list(range(50)) * 3 + [7]) * 3, [0] * 24 + [1] + [0] * 24,
    ],
)
def test_runs_of_made_rows(words):
    check([words])
    check([words, words, [], [0]])  # neighbouring rows do not touch


def test_zero_sums_are_exact():
    """Squared differences that are multiples of a prime are not taken for zero."""
    prime = periods.PRIMES[0][0]
    codes = np.array([1, 2, 1 + prime, 2, 5, 2, 1, 2], np.uint64)
    block, distance = periods.occurrences(codes, np.array([0]), 2, np.array([8]))
    assert (block.tolist(), distance.tolist()) == ([], [])
    block, distance = periods.occurrences(codes, np.array([0, 4]), 1, np.array([8, 8]))
    assert block.tolist() == []
    draw = np.random.default_rng(1)
    codes = draw.integers(1, 4, 400).astype(np.uint64)
    for scale in (1, 2, 4, 8):
        blocks = np.arange(0, 400 - 2 * scale, scale)
        got = set(zip(*(x.tolist() for x in periods.occurrences(codes, blocks, scale, np.full(len(blocks), 400))), strict=True))
        want = {
            (b, d) for b in blocks.tolist() for d in range(scale, 2 * scale)
            if b + d + scale <= 400 and (codes[b : b + scale] == codes[b + d : b + d + scale]).all()
        }
        assert got == want


def test_equal_hashes_of_different_stretches_are_noticed(monkeypatch):
    """With prefix hashes that are always equal the comparison word by word still gives the runs."""
    monkeypatch.setattr(periods.Prefixes, "same", lambda self, a, b, n: np.ones(len(a), bool))
    check([[5, 6, 7] + [0, 1] * 20 + [9, 9, 8]])


def test_long_rows_take_little_time():
    n = 60_000
    for words, q in (([1] * n, 1), ([i % 7 for i in range(n)], 7), ([i % 20_000 for i in range(n)], 20_000)):
        assert periods.runs(*hashed([words])).tolist() == [[0, 0, n, q]]
    draw = random.Random(2)
    assert len(periods.runs(*hashed([[draw.randrange(2) for _ in range(n)]]))) < 50


def plain_digest(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    original, n = list(words), len(words)
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [original[i] if i < a else original[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    kept = hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(runs), *four, listed, kept)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_digest_of_odd_rows(spark, edge, edge_rows, nothing):
    long = next(k for k in range(100, 400) if zlib.crc32(str(k).encode()) % 10 == 0)
    more = [(long, prose(7, 400)), (long + 1, "a b c " * 200 + "d " * 50 + "a b c " * 9), (long + 2, "x " * 24)]
    extra = spark.createDataFrame([(k, t) for k, t in more], "doc_id long, text string")
    rows = [(k, t) for k, t in edge_rows if t != LONG] + more
    got = periods.digest(edge.filter(f"text IS NULL OR length(text) < {len(LONG)}").select("doc_id", "text").union(extra)).collect()
    assert ordered(got) == ordered(plain_digest(k, t) for k, t in rows)
    assert ordered(r for r in periods.digest(edge).collect() if r.doc_id == 5)[0][1] == 0
    assert periods.digest(nothing).collect() == []


def test_digest_of_the_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 8000")
    got = periods.digest(docs).collect()
    assert ordered(got) == ordered(plain_digest(r.doc_id, r.text) for r in docs.collect())
    assert sum(r.n_runs > 0 for r in got) > 10


def test_stretches_and_collapse(spark):
    docs = spark.createDataFrame([(1, "go " + "a b c " * 10 + "stop"), (2, None), (3, "z " * 30)], "doc_id long, text string")
    assert ordered(periods.stretches(docs).collect()) == [(1, 1, 30, 3), (3, 0, 30, 1)]
    assert {r.doc_id: r.collapsed for r in periods.collapse(docs).collect()} == {1: "go a b c stop", 2: "", 3: "z"}
