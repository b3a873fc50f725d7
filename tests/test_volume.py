"""What moves and what is written: bytes that grow with the text are moved and stored as seldom as can be."""

import pickle
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewatch import session
from tidewatch.operators import keyphrases, language
from tidewatch.plans import enrichment, load_job, warehouse
from tidewatch.plans.enrichment import Resources
from tidewatch.queries import QUERIES, streams
from tidewatch.sources import views

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def posts(rows, n=40):
    data = [(i, " ".join(WORDS[(i * k) % len(WORDS)] for k in range(1, 4 + i % 9)), "en" if i % 3 else "fr") for i in range(n)]
    return rows(data, "post_id bigint, text string, language string")


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_languages_are_found_where_the_rows_are(rows):
    df = posts(rows)
    profile = language.fit_language_profile(df)
    assert exchanges(language.detect_language(df, profile)) == 0


def test_languages_with_more_grams_than_every_task_knows(rows, monkeypatch):
    df = posts(rows).unionByName(rows([(90, "12", "en"), (91, "你好 жз", "en"), (92, None, "en")], "post_id bigint, text string, language string"))
    profile = language.fit_language_profile(df)
    found = []
    for listed in (language.LISTED, 7):
        monkeypatch.setattr(language, "LISTED", listed)
        found.append({r.post_id: r.language for r in language.detect_language(df, profile).collect()})
        found.append({r.post_id: r.language for r in language.language_of(df, profile).collect()})
    assert found[0] == found[2] and found[1] == found[3] and len(found[1]) == 41
    assert {found[0][i] for i in range(40)} == {"en", "fr"} and found[0][90] == "unknown" and found[0][92] is None


def test_words_that_a_task_forgets_are_scored_again(monkeypatch):
    scores = language.WordScores({"_": [1, 2], "a": [3, 5]}, [-1, -7], True)
    first = scores.sums("a b a")[0].tolist()
    monkeypatch.setattr(language, "KEPT", 0)
    # _a_: two of "_", one of "a", and _a, a_, _a_ unseen; _b_: two of "_" and four unseen
    assert first == scores.sums("a b a")[0].tolist() == [2 * (2 + 3 - 3) + 2 - 4, 2 * (4 + 5 - 21) + 4 - 28]


@pytest.mark.parametrize("held", [keyphrases.COUNTED, 5])
def test_phrase_statistics_move_lists_and_no_rows_of_phrases(rows, monkeypatch, held):
    monkeypatch.setattr(keyphrases, "COUNTED", held)
    df = posts(rows)
    stats = keyphrases.phrase_stats(df)
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", stats._jdf.queryExecution().executedPlan().toString())
    assert moved == ["part"]
    want = Counter()
    for r in df.collect():
        w = r.text.split()
        want.update({*(x for x in w if len(x) > 1), *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))})
    assert [tuple(r) for r in stats.orderBy("phrase").collect()] == sorted(want.items())


def test_phrases_left_out_of_the_statistics_have_the_least_frequency(rows):
    df = posts(rows)
    whole = session.stage(keyphrases.phrase_stats(df), "stats")
    several = session.stage(whole.filter("df > 1"), "stats")
    assert several.count() < whole.count()
    for few in (keyphrases.FEW, 0):
        keyphrases.FEW, kept = few, keyphrases.FEW
        try:
            a = keyphrases.top_phrases(df, stats=whole, documents=40)
            b = keyphrases.top_phrases(df, stats=several, documents=40, least=1)
            assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        finally:
            keyphrases.FEW = kept


def test_a_load_stages_its_texts_once(spark, rows, tmp_path, monkeypatch):
    staged = []

    def noted(df, label, path=None, stage=session.stage):
        if "text" in df.columns:
            staged.append(label)
        return stage(df, label, path)

    for module in (session, enrichment, warehouse):
        monkeypatch.setattr(module, "stage", noted)
    df = posts(rows)
    resources = Resources(language.fit_language_profile(df))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    raw = df.select(F.concat(F.lit("k"), "post_id").alias("post_key"), F.lit("d").alias("did"), at.alias("created_at"), "text")
    load_job.run(raw, str(tmp_path / "t"), resources)
    assert staged == ["tagged"]
    written = spark.read.parquet(str(tmp_path / "t" / "posts"))
    names = {r.raw_post_key: len(r.keywords) for r in written.collect()}
    links = spark.read.parquet(str(tmp_path / "t" / "post_keywords"))
    assert len(names) == 40 and sum(names.values()) == links.count() > 0


def test_staged_tables_are_packed_and_shuffle_files_go_with_their_job(spark, tmp_path):
    conf = {k: spark.conf.get(k) for k in session.RUNTIME_CONF}
    assert conf["spark.sql.classic.shuffleDependency.fileCleanup.enabled"] == "true"
    session.stage(spark.range(9).selectExpr("CAST(id AS STRING) AS text").repartition(1), "packed", str(tmp_path / "p"))
    file = next((tmp_path / "p").glob("*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_a_small_table_is_dealt_out_and_a_large_one_is_not(spark, sf):
    cores = spark.sparkContext.defaultParallelism
    assert views.spread(views.documents(spark, sf), "doc_id").rdd.getNumPartitions() == cores
    assert exchanges(views.spread(spark.range(100, numPartitions=cores), "id")) == 0


@pytest.mark.parametrize("name", ["stage_then_load", "enrich_repeated_posts", "stream_enrichment"])
def test_streams_write_posts_as_seldom_as_they_can(spark, sf, tmp_path, monkeypatch, name):
    written = []
    monkeypatch.setattr(streams, "remove_folder", lambda spark, path: written.append(spark.read.parquet(path).count()))
    monkeypatch.setattr(session, "staging_root", lambda spark: str(tmp_path))
    assert QUERIES[name](spark, sf).count() > 0
    n = views.posts_base(spark, sf).count()
    assert written == [2 * n if name == "enrich_repeated_posts" else n]  # the only copies of the posts before the stream, and they go
    folders = list((tmp_path / "tidewatch").iterdir())
    labels = {re.sub("-[0-9a-f]{32}$", "", f.name) for f in folders}
    assert not labels & {"value-files", "message-files", "tagged" if name != "stage_then_load" else "enriched"}
    stats = [f for f in folders if re.match("(corpus-)?phrases-", f.name)]
    assert stats and all(spark.read.parquet(str(f)).agg(F.min("df")).first()[0] == 2 for f in stats)


def test_word_scores_keep_what_they_know_when_sent():
    scores = language.WordScores({"_": [1, 2], "a": [3, 5]}, [-1, -7], True)
    want = scores.sums("a b a")[0].tolist()
    sent = pickle.loads(pickle.dumps(scores))
    assert len(sent) == 2 and sent.sums("b a a")[0].tolist() == want
