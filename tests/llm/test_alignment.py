"""Cross-tokenizer alignment against the tokenizer libraries and plain loops."""

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewatch.llm import alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(alignment.BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL)


def plain(libraries, text):
    """Ids and bytes of both, or None where they do not join to the text."""
    a, b = libraries
    signs = alignment.printable()
    coded = a.encode(" " + text, add_special_tokens=False)
    ours = [(i, bytes(signs[c] for c in t)) for i, t in zip(coded.ids, coded.tokens, strict=True)]
    theirs = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        theirs.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (ours, theirs) if b"".join(x for _, x in ours) == whole == b"".join(x for _, x in theirs) else None


def expected(libraries, rows):
    seen, per = Counter(), []
    for _, text in rows:
        both = plain(libraries, text) if text else None
        if both is None:
            per.append(None)
            continue
        (a, b), groups, links = both, [], []
        ends_a, ends_b = (list(accumulate(len(x) for _, x in side)) for side in both)
        at = [0, 0]
        for end in sorted(set(ends_a) & set(ends_b)):
            group = []
            for k, (side, ends) in enumerate(((a, ends_a), (b, ends_b))):
                ids = []
                while at[k] < len(side) and ends[at[k]] <= end:
                    ids.append(str(side[at[k]][0]))
                    at[k] += 1
                group.append(",".join(ids))
            groups.append("|".join(group))
        for (i, x), e in zip(a, ends_a, strict=True):
            links += [(i, j) for (j, y), f in zip(b, ends_b, strict=True) if f > e - len(x) and f - len(y) < e]
        per.append((len(a), len(b), groups, links))
        seen.update(set(links))
    best = defaultdict(int)
    for (i, _), n in seen.items():
        best[i] = max(best[i], n)
    out = []
    for (key, _), found in zip(rows, per, strict=True):
        if found is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((key, n_a, n_b, len(groups), len(links), sum(seen[x] == best[x[0]] for x in links), sum(seen[x] for x in links), digest))
    return out, seen, Counter(x for p in per if p for x in p[3])


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r))


def short(rows):
    return [(k, t if t is None or len(t) < 20_000 else t[:4_000]) for k, t in rows]


def test_edge_rows_in_small_containers(spark, edge_rows, libraries, monkeypatch):
    """Plain loops take too long for the longest text: it is cut here; its whole length is tested below."""
    rows = short(edge_rows) + [(20, "<|endoftext|> <s> </s>"), (21, "naïve 日本語 👍🏽 ퟿"), (22, "\n\n  two\n \tspaces  \n"), (23, "it's 1234 we'll")]
    monkeypatch.setattr(alignment, "CONTAINER_BYTES", 500)
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, block string").repartition(3)
    got = alignment.align(docs).collect()
    want, _, _ = expected(libraries, rows)
    assert ordered(got) == ordered(want)
    assert sum(r[7] == "" for r in want) >= 4  # null, empty, and text with the sign for a space


def test_documents_and_their_pairs(spark, sf, libraries):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 3000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, seen, links = expected(libraries, rows)
    assert ordered(alignment.align(docs.withColumn("pair", docs.lang)).collect()) == ordered(want)
    best = defaultdict(int)
    for (i, _), n in seen.items():
        best[i] = max(best[i], n)
    pairs = {(r.a_id, r.b_id): (r.n_docs, r.n_links, r.best) for r in alignment.pairs(docs).collect()}
    assert pairs == {x: (n, links[x], n == best[x[0]]) for x, n in seen.items()}


def test_groups_join_to_the_text(spark, libraries):
    texts = ["plain words", None, "", "▁", "naïve  日本"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in alignment.groups(docs).collect():
        both = plain(libraries, texts[r.doc_id]) if texts[r.doc_id] else None
        assert (r.a_ids, r.b_ids) == (([i for i, _ in both[0]], [i for i, _ in both[1]]) if both else ([], []))
        if both:
            assert (r.a_upto[-1], r.b_upto[-1]) == (len(r.a_ids), len(r.b_ids))
            for x, y in zip(r.a_upto, r.b_upto, strict=True):
                assert b"".join(t for _, t in both[0][:x]) == b"".join(t for _, t in both[1][:y])


def test_very_long_text_and_empty_table(spark, nothing):
    long = "word after word " * 40_000
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    (row,) = alignment.align(docs).collect()
    assert row.n_a > 100_000 and row.n_links >= max(row.n_a, row.n_b) and row.count_sum == row.n_links >= row.n_best > 0
    assert alignment.align(nothing).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 40)), max_size=300))
def test_postings_pack_and_merge(links):
    """Bitmaps and planes come back as they went, whether dense or not; merging two halves is the whole."""
    pairs, docs = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
    whole = alignment.Postings.of(pairs, docs, 41)
    back = alignment.Postings.unpacked(*whole.packed(41), 41)
    early = docs < 20
    merged = alignment.Postings.merged([alignment.Postings.of(pairs[early], docs[early], 20), alignment.Postings.of(pairs[~early], docs[~early], 41)])
    for other in (back, merged):
        for field in ("pairs", "places", "docs", "times"):
            assert np.array_equal(getattr(whole, field), getattr(other, field))
    seen = Counter(links)
    n_docs, n_links = whole.counts()
    assert dict(zip(whole.pairs.tolist(), n_docs.tolist(), strict=True)) == Counter(p for p, _ in seen)
    assert dict(zip(whole.pairs.tolist(), n_links.tolist(), strict=True)) == Counter(p for p, _ in links)


def test_byte_tokens_are_the_librarys(libraries):
    """All of Latin, Greek, Cyrillic and more, in the places where words are cut."""
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)} \n{chr(c)} x{chr(c)}'s" for c in range(1, 0x3000)]
    ours = alignment.ByteTokens().encode(texts)
    theirs = libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in ours] == [e.ids for e in theirs]
