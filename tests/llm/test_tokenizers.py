import struct
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import prose

from tidewatch.llm import pieces as P
from tidewatch.llm import tokens as T
from tidewatch.llm.vocabulary import MODEL, Vocabulary

TEXTS = st.text(alphabet=st.sampled_from(list("the and ingtion  ABC12.,!\n\té▁ñ𝄞\x00中ß")), max_size=60)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


@pytest.fixture(scope="module")
def bpe():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


#: In place of scores of -10**9, beside which the library's single precision loses all others.
LEAST = -40_000.0


def as_unigram(path):
    """The model with its type field changed from merges to unigram: the same pieces and scores under the other rules."""
    raw, at, out = open(path, "rb").read(), 0, b""

    def varint(data, at):
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    def fields(data):
        at = 0
        while at < len(data):
            begin = at
            key, at = varint(data, at)
            if key & 7 == 2:
                size, at = varint(data, at)
                yield key >> 3, data[begin:at], data[at : at + size]
                at += size
            else:
                end = at + {1: 8, 5: 4}.get(key & 7, 0) if key & 7 else varint(data, at)[1]
                yield key >> 3, data[begin:at], data[at:end]
                at = end

    for number, head, body in fields(raw):
        if number == 1:  # a piece; field 2 is its score
            small = lambda b: struct.pack("<f", max(LEAST, struct.unpack("<f", b)[0]))
            body = b"".join(h + (small(b) if n == 2 else b) for n, h, b in fields(body))
        if number == 2:  # the trainer's settings; field 3 is the type, of which 1 is unigram
            body = b"".join(h + (b"\x01" if n == 3 else b) for n, h, b in fields(body))
        out += head + body
    assert len(out) == len(raw)
    return sentencepiece.SentencePieceProcessor(model_proto=out)


@pytest.fixture(scope="module")
def unigram():
    return as_unigram(MODEL)


@pytest.fixture(scope="module")
def counter(vocabulary):
    scores = {p: max(LEAST, s) for p, s in vocabulary.scores.items()}
    return T.Counter(Vocabulary(vocabulary.ids, scores, vocabulary.bytes_, vocabulary.pieces))


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_counts_are_the_unigram_tokenizers(counter, unigram, text):
    assert counter.text(text.replace("▁", " ")) == len(unigram.encode(text))


def test_counts_of_prose(counter, unigram):
    for k in range(200):
        text = prose(k, 60)
        assert counter.text(text) == len(unigram.encode(text))


def test_equal_scores_go_to_the_longest_last_piece():
    """Paths a|bc and ab|c have the same score; a third piece makes their numbers of pieces differ."""
    scores = {" ": -1.0, "a": -2.0, "b": -1.0, "c": -1.0, "bc": -2.0, "abc": -4.0, "d": 0.0, "x": -1.0, "xx": -2.0}
    counter = T.Counter(Vocabulary({p: i for i, p in enumerate(scores)}, scores, tuple(range(256)), tuple(scores)))
    assert counter.segment("abc") == 1 and counter.segment("bc") == 1 and counter.segment("xx") == 1 and counter.segment("xxx") == 2
    assert counter.segment("é") == 2 and counter.segment("aé") == 3


def whole_agenda(vocabulary, text):
    """Merging of a whole text at once, pair by pair."""
    parts = [c if c != "▁" else None for c in " " + text] if text else []
    while True:
        best = None
        for i in range(len(parts) - 1):
            if parts[i] is not None and parts[i + 1] is not None:
                score = vocabulary.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = (score, i)
        if best is None:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    out = []
    for p in parts:
        out += [vocabulary.ids[p]] if p in vocabulary.ids else [vocabulary.bytes_[b] for b in (p or "▁").encode()]
    return out


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_without_dropout_pieces_are_the_tokenizers(vocabulary, bpe, text):
    encoder = P.Encoder(vocabulary, dropout=0.0)
    ids = encoder.encode(text, 0)
    assert ids == whole_agenda(vocabulary, text)
    if "▁" not in text:
        assert ids == bpe.encode(text)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([0.0, 0.1, 0.5, 1.0]), st.integers(0, 3))
def test_any_dropout_decodes_to_the_text(vocabulary, text, dropout, variant):
    encoder, decoder = P.Encoder(vocabulary, dropout), P.Decoder(vocabulary)
    ids = encoder.encode(text, variant)
    assert decoder.decode(ids) == text and ids == P.Encoder(vocabulary, dropout).encode(text, variant)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.text(max_size=12)), max_size=12), st.sampled_from([0.0, 0.2, 0.5, 1.0]))
def test_segments_merged_together_are_those_merged_one_by_one(vocabulary, texts, dropout):
    encoder = P.Encoder(vocabulary, dropout)
    parts = [p for t in texts for p in P.segments(t)] + ["x" * 70, " " + "the" * 30]
    for variant in (0, 3):
        assert encoder.segments(parts, variant) == [encoder.segment(p, variant) for p in parts]
    ids = encoder.encode_all([*texts, None], list(range(len(texts) + 1)))
    assert ids[-1] is None and ids[:-1] == [encoder.encode(t, encoder.variant(k)) for k, t in enumerate(texts)]


def test_dropout_varies_segmentations_at_its_rate(vocabulary):
    text = prose(3, 400)
    by = {v: P.Encoder(vocabulary, 0.3).encode(text, v) for v in range(4)}
    assert len({tuple(x) for x in by.values()}) == 4
    assert P.Encoder(vocabulary, 0.3, seed=1).encode(text, 0) != by[0]
    plain, all_skipped = P.Encoder(vocabulary, 0.0).encode(text, 0), P.Encoder(vocabulary, 1.0).encode(text, 0)
    assert len(plain) < len(by[0]) < len(all_skipped) == len(text) + 1
    skipped = Counter()
    encoder = P.Encoder(vocabulary, 0.25)
    for k in range(4000):  # two characters have one merge
        skipped[len(encoder.segment(" t", 0) if k < 1 else encoder.segment("th", k))] += 1
    assert 0.2 < skipped[2] / 4000 < 0.3


def test_columns(spark, edge, edge_rows, nothing, vocabulary):
    coded = P.encode(edge)
    assert coded.columns == [c for c in edge.columns if c != "piece_ids"] + ["piece_ids", "n_pieces", "lossless"]
    rows = coded.collect()
    assert len(rows) == len(edge_rows) and all(r["lossless"] == (None if r["text"] is None else True) for r in rows)
    assert {r["doc_id"]: r["n_pieces"] for r in rows if r["doc_id"] in (1, 2, 4)} == {1: 0, 2: 0, 4: P.Encoder(vocabulary).encode("one", 0).__len__()}
    back = P.decode(coded.drop("text"))
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in back.collect()) == sorted((str(k), str(t)) for k, t in edge_rows)
    assert P.encode(nothing).collect() == []
    counts = T.count(edge).collect()
    counter = T.Counter(vocabulary)
    want = sorted((str(k), counter.text((t or "").replace("▁", " "))) for k, t in edge_rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in counts) == want and T.count(nothing).collect() == []


def test_documents_take_different_variants(spark):
    text = prose(9, 300)
    rows = P.encode(spark.createDataFrame([(k, text) for k in range(40)], "doc_id long, text string"), dropout=0.3).collect()
    assert len({tuple(r["piece_ids"]) for r in rows}) == 4


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.text(max_size=12), st.none()), max_size=12), st.sampled_from([0.0, 0.2, 0.5, 1.0]))
def test_occurrences_found_together_are_those_found_one_by_one(vocabulary, texts, dropout):
    encoder, decoder = P.Encoder(vocabulary, dropout, variants=None), P.Decoder(vocabulary)
    texts = [*texts, "the thing and the thing " * 4, "x" * 70 + " the"]
    for _ in range(2):  # the second time by the paths that are kept
        ids = encoder.encode_each(texts, list(range(len(texts))))
        assert ids == [None if t is None else encoder.encode_here(t, k) for k, t in enumerate(texts)]
    assert all(t is None or decoder.decode(i) == t for t, i in zip(texts, ids))


def test_every_occurrence_has_its_own_skips(spark, sf):
    from tidewatch.llm.queries import QUERIES

    text = prose(9, 300)
    df = spark.createDataFrame([(k, text) for k in range(40)], "doc_id long, text string")
    rows = P.encode(df, dropout=0.3, variants=None).collect()
    assert len({tuple(r["piece_ids"]) for r in rows}) == 40
    assert rows == P.encode(df.repartition(3), dropout=0.3, variants=None).orderBy("doc_id").collect()
    encoder = P.Encoder(Vocabulary.load(), 0.25, variants=None)
    found = set(encoder.encode_each(["\nth" * 4000], [1])[0][1:])
    assert len(found) > 3  # a line feed, "th", and its parts
    got = {r["doc_id"]: r["piece_ids"] for r in QUERIES["op7_pieces"](spark, sf).collect()}
    encoder = P.Encoder(Vocabulary.load(), variants=None)
    for r in spark.read.parquet(f"{sf}/documents.parquet").limit(20).collect():
        assert got[r["doc_id"]] == encoder.encode_here(r["text"], r["doc_id"])
