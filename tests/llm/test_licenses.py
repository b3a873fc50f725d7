import regex
from texts import prose

from tidewatch.llm import licenses as L


def words(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def shingles(ws):
    return [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]


def brute(rows, notices):
    out = {}
    for key, text in rows:
        own = shingles(words(text))
        for name, notice in notices:
            theirs = set(shingles(words(notice)))
            need, step = -(-len(theirs) * 8 // 10), 1
            while step < len(theirs):
                step *= 2
            for at in range(0, len(own), step):
                part = own[at : at + 2 * step]
                common = theirs & set(part)
                if len(common) >= need:
                    share, first = out.get((key, name), (0, 10**9))
                    here = at + min(part.index(s) for s in common)
                    out[key, name] = (max(share, len(common) / len(theirs)), min(first, here))
    return out


def run(df, notices=L.NOTICES):
    return {(r["doc_id"], r["license"]): (r["containment"], r["first_word"]) for r in L.scan(df, notices).collect()}


def test_notices_in_texts(spark):
    rows = [(k, prose(k, 60)) for k in range(20)]
    rows += [(100 + k, prose(k, 3 * k) + "\n" + notice.upper() + " " + prose(k + 50, 7)) for k, (_, notice) in enumerate(L.NOTICES)]
    rows += [(200, "Released under the MIT license"), (201, "released under the"), (202, L.NOTICES[0][1] * 3 + prose(4, 500) + L.NOTICES[12][1])]
    got = run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got == brute(rows, L.NOTICES) and (200, "MIT") in got and {k for k, _ in got} == {200, 202, *range(100, 116)}


def test_long_templates(spark):
    notices = [("long", prose(70, 300)), ("longer", prose(71, 700)), ("short", "five words and no more")]
    part = " ".join(prose(71, 700).split()[40:680])
    rows = [(1, prose(1, 333) + " " + notices[0][1] + " " + prose(2, 99)), (2, prose(3, 55) + " " + part), (3, " ".join(part.split()[:500])), (4, "five words, and no more")]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"), notices)
    assert got == brute(rows, notices) and set(got) == {(1, "long"), (2, "longer"), (4, "short")}


def test_edges(spark, edge, edge_rows, nothing):
    notices = [("prose", " ".join(edge_rows[5][1].split()[10:40]))]
    got = L.scan(edge, notices).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["-9", "6", "7", "None"] and L.scan(nothing).collect() == []


def test_no_python_in_the_plan(edge):
    plan = L.scan(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
