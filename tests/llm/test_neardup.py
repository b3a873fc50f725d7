import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from texts import prose

from tidewatch.llm import neardup as N
from tidewatch.llm.components import components


def brute(rows, size=4):
    """component of each id, by all pairs that share a shingle."""
    sets = defaultdict(list)
    for key, text in rows:
        words = (text or "").encode().lower().split()
        own = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        if key is not None:
            sets[key].append(own)
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for key, owns in sets.items():
        for n, own in enumerate(owns):
            for s in own:
                holders[s].add((key, n))
    for key, owns in sets.items():
        for own in owns:
            for (other, n), common in Counter(h for s in own for h in holders[s]).items():
                if 100 * common >= 80 * (len(own) + len(sets[other][n]) - common):
                    a, b = find(key), find(other)
                    parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(w if draw.random() > share else f"e{draw.randrange(10**6)}" for w in text.split())


def check(rows, df):
    want = brute(rows)
    got = N.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == want[r["doc_id"]]) for r in got)
    return want


def test_edges(edge, edge_rows, nothing):
    check(edge_rows, edge)
    assert N.near_duplicates(nothing).collect() == []
    kept = N.firsts(edge)
    assert kept.columns == edge.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 8, None, -9, 10, 12, 13}


def test_groups_of_copies_at_every_distance(spark):
    """A large group whose members are alike to all degrees, chains, copies, and strangers."""
    rows = [(k, prose(k, 150)) for k in range(40)]
    base = prose(999, 200)
    rows += [(100 + k, edited(base, (k % 40) / 400, k)) for k in range(400)]
    chain = prose(77, 160).split()
    rows += [(900 + k, " ".join(chain[k * 6 : k * 6 + 90])) for k in range(11)]
    rows += [(1000 + k, base.upper()) for k in range(30)]
    want = check(rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    sizes = Counter(want.values())
    assert max(sizes.values()) > 100 and len(sizes) > 50


def test_odd_sketches_tell_similarity():
    rng = np.random.default_rng(5)
    for similarity in (0.7, 0.8, 0.9, 1.0):
        common, n = rng.integers(0, 2**63, 4000, np.uint64), round(4000 * (1 - similarity) / 2 / similarity)
        sets = [np.concatenate([common, rng.integers(0, 2**63, n, np.uint64)]) for _ in range(2)]
        values = N.min_hashes(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]))
        a, b = N.odd_sketches(values).view(np.uint64)
        differing = int(np.bitwise_count(a ^ b).sum())
        assert N.max_differing_bits(similarity + 0.12) - 1 <= differing <= N.max_differing_bits(similarity - 0.12)


@pytest.mark.parametrize("round_", [0, 1])
def test_the_rest_is_compared_without_stars(spark, monkeypatch, round_):
    """With no rounds of stars (or one), chunks alone have to find every link."""
    monkeypatch.setattr(N, "STARS", round_)
    monkeypatch.setattr(N, "CHUNK", 7)
    base = prose(5, 120)
    rows = [(k, edited(base, (k % 12) / 150, k)) for k in range(60)]
    check(rows, spark.createDataFrame(rows, "doc_id long, text string"))


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 70)] + [(200, 201), (201, 200), (300, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 71)}, 200: 200, 201: 200, 300: 300}


def test_sets_of_a_block():
    rows, hashes = N.shingle_sets(pa.array(["a b c d a b c d a b c d", "A b", None, "a B"]), 4)
    assert np.bincount(rows, minlength=4).tolist() == [4, 1, 0, 1] and hashes[-1] == hashes[-2]


@pytest.mark.parametrize("turned", [False, True])
def test_texts_that_share_an_id_keep_all_their_links(spark, turned):
    """Both texts of id 5 have a near copy, and ids 20 and 21 meet only by way of the second text of 20."""
    a, b, c, d = (prose(k, 200) for k in (1, 2, 3, 4))
    rows = [(5, a), (5, b), (8, edited(a, 0.005, 1)), (9, edited(b, 0.005, 2)), (20, c), (20, d), (21, d.upper()), (21, d), (3, None), (3, edited(c, 0.005, 3))]
    rows += [(5, a), (30, "one"), (31, "ONE"), (31, "two"), (32, "two")]
    rows = rows[::-1] if turned else rows
    want = check(rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert want == {5: 5, 8: 5, 9: 5, 20: 3, 21: 3, 3: 3, 30: 30, 31: 30, 32: 30}


def test_ids_of_text(spark):
    base = prose(6, 100)
    rows = [("b", base), ("a", edited(base, 0.01, 1)), ("c", prose(7, 80)), ("c", base), ("d", prose(7, 80))]
    check(rows, spark.createDataFrame(rows, "doc_id string, text string"))
