import hashlib
import math
import zlib
from collections import Counter, defaultdict

from tidewatch.llm import sharding as S


def brute(key, weights):
    def score(s):
        digits = hashlib.md5(f"{'' if key is None else key}:{s}".encode()).hexdigest()[:13]
        return (-weights[s] / math.log((int(digits, 16) + 0.5) / 16.0**13), -s)

    return max(range(len(weights)), key=score)


def check(df, rows, weights=(1.0,) * 8, grown=None):
    got = S.shard(df, weights, grown).collect()
    more = grown or (*weights, 1.0)
    want = sorted(
        (str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), brute(k, weights), brute(k, more)) for k, t in rows
    )
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key"
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return got


def test_edges(edge, edge_rows, nothing, monkeypatch):
    check(edge, edge_rows)
    monkeypatch.setattr(S, "BUCKET_ROWS", 1)
    check(edge, edge_rows, (1.0, 2.0))
    assert S.shard(nothing).collect() == []


def test_shares_follow_weights_and_growth_moves_rows_into_the_new_shard_only(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", 100)
    rows = [(k, "same" if k % 3 else f"text {k}") for k in range(6000)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows, (1.0, 2.0, 3.0), (1.0, 2.0, 3.0, 2.0))
    sizes = Counter(r["shard"] for r in got)
    assert [abs(sizes[s] / 6000 - (s + 1) / 6) < 0.03 for s in range(3)] == [True] * 3
    moved = [r for r in got if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {3} and 0.2 < len(moved) / 6000 < 0.3
