import random

import numpy as np
import pyarrow as pa

from tidewatch.llm import quality as Q

ROWS = [
    None, "", " \n ", "a b c", "word " * 49, "word " * 50, " ".join(f"w{i}" for i in range(80)), "\n".join(["same line here"] * 30),
    " ".join(f"#{i}$$" for i in range(90)), " ".join("x" * 40 + str(i) for i in range(60)), " ".join(str(i * 7919) for i in range(70)),
    "é " * 10 + " ".join(f"mot{i}é" for i in range(60)),
]


def test_cascade_keeps_what_no_rule_rejects_in_any_order():
    column = pa.array(ROWS, pa.string())
    rules = list(Q.BASE + Q.EXTRA)
    want = ~np.logical_or.reduce([r.rejects(Q.Texts(column)) for r in rules])
    for seed in range(5):
        random.Random(seed).shuffle(rules)
        assert Q.cascade(rules, Q.Texts(column)).tolist() == np.flatnonzero(want).tolist()
    assert want[6] and want[11] and want.sum() == 2


def test_later_rules_see_only_survivors():
    seen = []

    def rule(name, bad):
        return Q.Rule(name, lambda t: seen.append((name, len(t.column))) or np.array([x in bad for x in t.column.to_pylist()]))

    kept = Q.cascade([rule("first", {"a", "b"}), rule("second", {"c"})], Q.Texts(pa.array(["a", "b", "c", "d"])))
    assert kept.tolist() == [3] and seen == [("first", 4), ("second", 2)]


def test_rules_are_ordered_by_rejection_per_cost():
    found = [
        {"name": "few_words", "seconds": 4.0, "seen": 9, "rejected": 8},
        {"name": "repeats", "seconds": 1.0, "seen": 9, "rejected": 4},
    ]
    assert [r.name for r in Q.ordered(Q.BASE, found)] == ["repeats", "few_words"]


def test_estimates_come_from_a_bounded_sample(spark):
    docs = spark.createDataFrame([(t,) for t in ROWS], "text string")
    found = Q.estimate(docs, Q.BASE, rows=5)
    assert [f["seen"] for f in found] == [5, 5] and found[0]["rejected"] == 5 and all(f["seconds"] >= 0 for f in found)


def test_edges(edge, edge_rows, nothing):
    got = sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in Q.measure(edge).collect())
    assert len(got) == len(edge_rows) and (5, 60_000, False) in got and (0, 0, False) in got
    kept = Q.keep(edge)
    assert kept.columns == edge.columns and kept.count() == sum(k for *_, k in got)
    assert Q.measure(nothing).collect() == [] and Q.keep(nothing).collect() == []
