import numpy as np
import pyarrow as pa
from test_decontaminate import brute as leaks
from test_neardup import brute as groups
from test_secrets import brute as spans

import corpus_pipeline
from tidewatch.llm import pieces, quality
from tidewatch.llm.vocabulary import Vocabulary


def test_rows_are_those_of_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    texts = quality.Texts(pa.array([t for _, t in docs], pa.string()))
    bad = np.logical_or.reduce([rule.rejects(texts) for rule in quality.BASE + quality.EXTRA])
    docs = [d for d, b in zip(docs, bad) if not b]
    first = groups(docs)
    docs = [d for d in docs if first[d[0]] == d[0]]
    leaking = leaks(docs, items)
    docs = [d for d in docs if d[0] not in leaking]
    assert 0 < len(docs) < 200 and leaking
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert sorted(rows) == sorted(k for k, _ in docs)
    decoder = pieces.Decoder(Vocabulary.load())
    for key, text in docs:
        row = rows[key]
        assert row["lossless"] and decoder.decode(row["piece_ids"]) == row["text"] and row["n_chars"] == len(row["text"])
        if not spans(text):
            assert row["text"] == text or "[SECRET]" in row["text"]
        else:
            assert not spans(row["text"]) and "[SECRET]" in row["text"]


def test_stages_keep_columns_and_stand_edges(spark, edge, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, sf).columns == documents.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge, sf).count() > 0 and stage(spark, edge.limit(0), sf).collect() == []
