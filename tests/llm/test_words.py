import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \n\tabABé▁ .\x00", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_windows(texts):
    column = pa.array(texts, pa.string())
    words = W.cut(column)
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    raw = words.data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(words.starts[i:j], words.ends[i:j])] for i, j in zip(words.rows, words.rows[1:])]
    assert got == want
    flat = [w for row in want for w in row]
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len(set(flat))
    at, found = W.windows(hashes, words.rows, 2)
    pairs = [tuple(row[i : i + 2]) for row in want for i in range(len(row) - 1)]
    assert len(at) == len(pairs) and len(set(found.tolist())) == len(set(pairs))


def test_a_word_longer_than_a_chunk_hashes_as_itself():
    long = "ab" * W.CHUNK
    words = W.cut(pa.array([long, "x " + long, long + "c", "ab"]))
    h = words.hashes()
    assert h[0] == h[2] and len({int(x) for x in h}) == 4


def test_sliced_columns():
    column = pa.array(["zero", None, "one two", "", "three"]).slice(1, 3)
    assert W.cut(column).counts.tolist() == [0, 2, 0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=20), st.booleans())
def test_packing(values, ascending):
    values = np.array(sorted(values) if ascending else values, np.uint64)
    assert W.unpack(W.pack(values, ascending)).tolist() == values.tolist()


@pytest.mark.parametrize("limit", [1, 10, 1000])
def test_blocks_keep_all_rows(limit):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 7, None, "", "b" * 30, "c"], pa.string())})
    assert [t for b in W.blocks([batch], "text", limit) for t in b.column("text").to_pylist()] == batch.column("text").to_pylist()
