import hashlib
import re

from tidewatch.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    """What stays of each row; places of rows that share an id are one space, as the module says."""
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (key, _), ws in zip(rows, words):
        for i in range(len(ws) - size + 1):
            if key is not None:
                w = tuple(ws[i : i + size])
                first[w] = min(first.get(w, (key, i)), (key, i))
    gone = set()
    for (key, _), ws in zip(rows, words):
        for i in range(len(ws) - size + 1):
            if key is not None and (key, i) > first[tuple(ws[i : i + size])]:
                gone |= {(key, i + k) for k in range(size)}
    out = []
    for (key, _), ws in zip(rows, words):
        stay = [w for i, w in enumerate(ws) if (key, i) not in gone]
        out.append((key, len(ws), len(ws) - len(stay), " ".join(stay)))
    return sorted(out, key=str)


def test_edges(edge, edge_rows):
    for size in (20, 3):
        got = sorted((tuple(r) for r in substring.dedup(edge, size).collect()), key=str)
        assert got == brute(edge_rows, size)


def test_a_passage_that_most_documents_share(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(k, f"a{k} " * 5 + (passage if k % 3 else "") + f" b{k}" * 30) for k in range(-50, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((tuple(r) for r in substring.dedup(df).collect()), key=str)
    assert got == brute(rows, 20)
    digests = {r["doc_id"]: r["kept_sha256"] for r in substring.digest(df).collect()}
    assert digests == {k: hashlib.sha256(t.encode()).hexdigest() for k, _, _, t in got}


def test_nothing(nothing):
    assert substring.digest(nothing).collect() == []
