import re
from collections import Counter

import numpy as np
import pytest
from texts import prose

from tidewatch.llm import decontaminate as D

ITEMS = [(1, prose(501, 40)), (2, prose(502, 15)), (3, "Just four small words."), (4, None), (5, ""), (6, prose(501, 40).upper()), (7, prose(503, 60)), (None, prose(504, 30))]


def plain(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in text or "").split()


def brute(rows, items):
    """Documents by similarity of every window with every item."""
    shingles = lambda w, size: Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out, seen = {}, set()
    for key, item in sorted((k, tuple(plain(t))) for k, t in items if k is not None and plain(t)):
        if item in seen:
            continue
        seen.add(item)
        size = min(5, len(item))
        own = shingles(item, size)
        for doc, text in rows:
            words = plain(text)
            length = min(len(item), len(words))
            for start in range(len(words) - length + 1 if length >= size else 0):
                there = shingles(tuple(words[start : start + length]), size)
                alike = (own & there).total() / (own | there).total()
                if alike >= 0.8:
                    found = out.setdefault(doc, {})
                    found[key] = max(found.get(key, (0, 0)), (alike, -start))
    best = {}
    for doc, found in out.items():
        alike, key = max((v[0], -k) for k, v in found.items())
        best[doc] = (-key, round(alike, 9), -found[-key][1], len(found))
    return best


def test_planted_items_and_clean_documents(spark):
    item = dict(ITEMS)
    cut = " ".join(item[7].split()[:-3])  # 53 of 56 shingles
    rows = [(k, prose(k, 200)) for k in range(30)]
    rows += [
        (100, prose(1, 50) + " " + item[1] + " " + prose(2, 50)), (101, prose(1, 30) + "\n" + item[2].replace(" ", ", ") + "!"),
        (102, item[1]), (103, item[7] + " " + prose(9, 20) + " " + item[1]), (104, prose(1, 10) + " " + cut),
        (105, prose(4, 9) + " just FOUR small: words " + prose(5, 9)), (106, " ".join(item[1].split()[:20])), (107, None), (108, ""),
        (109, cut),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["item_id"], round(r["similarity"], 9), r["start"], r["n_items"]) for r in D.leaks(docs, items).collect()}
    assert got == brute(rows, ITEMS) and set(got) == {100, 101, 102, 103, 104, 105, 109}
    assert {r["doc_id"] for r in D.clean(docs, items).collect()} == {k for k, _ in rows} - set(got)


def test_the_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    items = D.Items(list(range(50)), [prose(k, 30) for k in range(50)])
    own = items.index[30][1]
    bits = np.unpackbits(own.view(np.uint8), axis=1)
    for distance in (0, 5, 31, 32):
        for k in range(50):
            other = bits[k].copy()
            other[rng.choice(128, distance, replace=False)] ^= 1
            which, item = items._candidates(30, np.packbits(other).view(np.uint64).reshape(1, 2))
            near = np.bitwise_count(own ^ np.packbits(other).view(np.uint64)).sum(axis=1) <= D.RADIUS
            assert item.tolist() == np.flatnonzero(near).tolist() and (k in item) == (distance <= 31)


def test_large_benchmarks_are_read_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(k, prose(600 + k, 20)) for k in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(k, prose(600 + k, 20) + " " + prose(k, 20)) for k in range(60)], "doc_id long, text string")
    one = sorted(D.leaks(docs, items).collect())
    monkeypatch.setattr(D, "BENCHMARK_BYTES", 2000)
    assert len(list(D.item_blocks(items))) > 3 and sorted(D.leaks(docs, items).collect()) == one and len(one) == 40
    assert D.clean(docs, items).count() == 20


def test_edges(spark, edge, edge_rows, nothing):
    items = spark.createDataFrame([(1, edge_rows[5][1]), (2, "one"), (3, None)], "item_id long, text string")
    got = D.leaks(edge, items).collect()
    assert len({r["doc_id"] for r in got}) == len(got) == 5  # 4, 6, 7, -9 and null
    assert D.clean(edge, items).columns == edge.columns and D.clean(edge, items).count() == len(edge_rows) - 6
    assert D.leaks(nothing, items).collect() == [] and D.leaks(edge, items.limit(0)).collect() == []
    assert D.clean(edge, items.filter("text IS NULL")).count() == len(edge_rows)


@pytest.mark.parametrize("a,b", [("abcab", "abcab"), ("aab", "ab"), ("abc", "xyz"), ("aabbcc", "abcabd")])
def test_weighted_similarity(a, b):
    x, y = (np.array([ord(c) for c in t], np.uint64) for t in (a, b))
    want = (Counter(a) & Counter(b)).total() / (Counter(a) | Counter(b)).total()
    zeros = lambda n: np.zeros(n, np.int64)
    assert D.similarity(zeros(len(x)), x, zeros(len(y)), y, 1)[0] == pytest.approx(want)
    assert re.fullmatch("[a-z]+", a)


def test_the_index_retrieves_few_unrelated_items():
    rng = np.random.default_rng(3)
    items = D.Items(list(range(3000)), [prose(k, 12) for k in range(3000)])
    windows = rng.integers(0, 1 << 63, (200, 2), np.uint64)
    which, item = items._retrieved(12, windows)
    assert len(np.unique(which * 3000 + item)) == len(which) < 0.1 * 200 * 3000
    prints = np.concatenate([items.index[12][1][:500]] * 2)
    which, item = items._candidates(12, prints)
    near = np.bitwise_count(prints[:, None] ^ items.index[12][1][None]).sum(axis=2) <= D.RADIUS
    assert sorted(zip(which.tolist(), item.tolist(), strict=True)) == [tuple(p) for p in np.argwhere(near).tolist()]


def test_items_without_an_id(spark):
    items = [(None, prose(801, 30)), (None, prose(802, 30)), (4, prose(802, 30)), (None, prose(803, 30)), (9, prose(803, 31)), (None, None)]
    docs = [(k, prose(800 + k, 31) + " " + prose(k, 20)) for k in range(5)]
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["item_id"], r["n_items"]) for r in D.leaks(docs, items).collect()}
    assert got == {1: (None, 1), 2: (4, 1), 3: (9, 2)}
    assert sorted(r["doc_id"] for r in D.clean(docs, items).collect()) == [0, 4]
