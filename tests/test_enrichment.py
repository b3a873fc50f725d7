"""Language, safety, sentiment, keyphrases."""

import hashlib
import json
import math
import re
import uuid
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch import constants
from tidewatch.operators import bayes, classifier, joins, keyphrases, language, safety, semantic, sentiment
from tidewatch.plans.enrichment import Resources, enrich_legacy, enrich_posts
from tidewatch.session import stage
from tidewatch.sources import views


@pytest.fixture(scope="module")
def docs(spark, sf):
    return views.posts_base(spark, sf).cache()


@pytest.fixture(scope="module")
def profile(docs):
    return language.fit_language_profile(docs)


def brute_force_phrases(texts, n, stop):
    """Top phrases by the plain definition."""
    counts = {}
    for key, text in texts.items():
        words = [w for w in re.findall(r"\w{2,}", text.lower()) if w not in stop]
        counts[key] = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)])
    df = Counter(p for c in counts.values() for p in c)
    top = {}
    for key, c in counts.items():
        scored = [(-round(tf * (math.log((len(texts) + 1) / (df[p] + 1)) + 1), 6), p) for p, tf in c.items()]
        top[key] = [(p, -s) for s, p in sorted(scored)[:n]]
    return top


TEXTS = {
    1: "the cat sat on the mat and the cat ran",
    2: "a dog and a cat, a dog and a bird; the dog ran",
    3: "",
    4: "the of and",
    5: "Café time: café TIME again! x y z 42",
    6: None,
}


def texts_frame(rows):
    return rows(list(TEXTS.items()), "post_id bigint, text string")


@pytest.fixture(params=["10m", "-1"])
def broadcasts(spark, request):
    """With and without broadcast joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keyphrases_by_brute_force(rows, broadcasts):
    stop = constants.STOP_WORDS
    want = brute_force_phrases({k: t or "" for k, t in TEXTS.items()}, 3, set(stop))
    got = {k: [] for k in TEXTS}
    for r in keyphrases.top_phrases(texts_frame(rows)).orderBy("post_id", "rank").collect():
        got[r.post_id].append((r.keyword, r.score))
    assert {k: [p for p, _ in v] for k, v in got.items()} == {k: [p for p, _ in v] for k, v in want.items()}
    for k in TEXTS:
        assert [s for _, s in got[k]] == pytest.approx([s for _, s in want[k]], abs=2e-6)


def test_bigrams_bridge_stop_words_and_sizes_can_be_chosen(rows):
    df = rows([(1, "cats of the night sky")], "post_id int, text string")
    names = {r.phrase for r in keyphrases.candidates(df).collect()}
    assert names == {"cats", "night", "sky", "cats night", "night sky"}
    assert {r.phrase for r in keyphrases.candidates(df, ngram=(3, 3)).collect()} == {"cats night sky"}
    assert {r.phrase for r in keyphrases.candidates(df, ngram=(2, 4), stop_words=("of", "the")).collect()} == {
        "cats night", "night sky", "cats night sky",
    }


def test_given_statistics_are_used(rows, spark):
    df = rows([(1, "alpha beta")], "post_id bigint, text string")
    stats = stage(rows([("alpha", 9), ("beta", 1)], "phrase string, df bigint"), "stats")
    got = {r.keyword: r.score for r in keyphrases.top_phrases(df, stats=stats, documents=9).collect()}
    assert got["alpha"] == 1.0 and got["beta"] == round(math.log(5) + 1, 6) and got["alpha beta"] == round(math.log(10) + 1, 6)


def test_keyword_gate(rows, spark):
    cases = [(1, "en", True), (2, "en", False), (3, "fr", True), (4, None, True), (5, "en", None)]
    df = rows([(*c, "apple banana") for c in cases], "post_id int, language string, sfw boolean, text string")
    got = keyphrases.keywords(df, only=(F.col("language") == "en") & F.col("sfw"))
    by_id = {r.post_id: json.loads(r.keywords) for r in got.collect()}
    assert [p for p, _ in by_id[1]] == ["apple", "apple banana", "banana"]
    assert all(by_id[i] == [] for i in (2, 3, 4, 5))


def test_keyword_json_escapes_and_reads_back(rows):
    df = rows([([{"keyword": 'a "b" \\c', "score": 0.5}],), ([],), (None,)], "p array<struct<keyword:string,score:double>>")
    from tidewatch.functions.text import keywords_to_json

    got = [r[0] for r in df.select(keywords_to_json(F.col("p"))).collect()]
    assert json.loads(got[0]) == [['a "b" \\c', 0.5]] and got[1] == "[]" and got[2] is None


def test_language_scores_by_brute_force(docs, profile, broadcasts):
    """Ready-made words and n-grams, broadcast or shuffled, give the plain naive Bayes answer."""
    scores = {}
    for r in profile.table.filter(F.col("kind") == language.GRAM).collect():
        scores[r["item"]] = r["scores"]
    sample = docs.filter(F.length("text") < 1500).select("post_id", "text")
    want = {}
    for r in sample.collect():
        words = re.findall(r"[^\W\d_]+", r.text.lower())
        total = dict.fromkeys(profile.languages, 0)
        for w in (f"_{w}_" for w in words):
            for n in (1, 2, 3):
                for i in range(len(w) - n + 1):
                    for c in total:
                        total[c] += scores.get(w[i : i + n], profile.unseen)[c]
        want[r.post_id] = min(total, key=lambda c: (-total[c], c)) if words else None
    got = {r.post_id: r.language for r in language.language_of(sample, profile).collect()}
    assert len(want) > 20 and got == {k: v for k, v in want.items() if v}


def test_language_edges(rows, profile):
    df = rows([(1, None), (2, ""), (3, "12 !?"), (4, "   "), (5, "你好 жз")], "post_id int, text string")
    got = {r.post_id: r.language for r in language.detect_language(df, profile).collect()}
    assert (got[1], got[2], got[3], got[4]) == (None, None, "unknown", "unknown")
    assert got[5] in profile.languages


def test_language_on_documents_not_trained_on(docs):
    held_out = F.col("post_id") % 5 == 0
    profile = language.fit_language_profile(docs.filter(~held_out))
    rest = docs.filter(held_out & F.col("text").rlike(r"\p{L}")).withColumnRenamed("language", "true_language")
    right, total = (
        language.detect_language(rest, profile)
        .agg(F.sum((F.col("language") == F.col("true_language")).cast("int")), F.count("*"))
        .first()
    )
    assert total >= 30 and right / total >= 0.95


def test_profile_can_be_stored(docs, spark, tmp_path):
    path = str(tmp_path / "profile")
    kept = language.fit_language_profile(docs, path=path)
    loaded = language.load_language_profile(spark.read.parquet(path))
    assert (loaded.languages, loaded.unseen) == (kept.languages, kept.unseen)


def test_sfw_by_list_and_by_table(rows, broadcasts, monkeypatch):
    df = rows([(1, "You IDIOT!"), (2, "idiotic plan"), (3, None), (4, ""), (5, "fine")], "post_id int, text string")
    listed = {r.post_id: r.sfw for r in safety.flag_sfw(df).collect()}
    words = rows([(w,) for w in constants.UNSAFE_WORDS], "w string")
    joined = {r.post_id: r.sfw for r in safety.flag_sfw(df, words).collect()}
    monkeypatch.setattr(safety, "LITERAL_WORDS", 3)
    long_list = {r.post_id: r.sfw for r in safety.flag_sfw(df).collect()}
    assert listed == joined == long_list == {1: False, 2: True, 3: True, 4: True, 5: True}


def test_sfw_against_labels(spark, docs):
    labels = views.labels(spark, "/root/testdata/sf0.01").withColumnRenamed("doc_id", "post_id")
    flagged = safety.flag_sfw(views.posts_base(spark, "/root/testdata/sf0.01")).join(labels, "post_id")
    hit, found, toxic = flagged.agg(
        F.sum(((~F.col("sfw")) & (F.col("toxic") == 1)).cast("int")),
        F.sum((~F.col("sfw")).cast("int")),
        F.sum("toxic"),
    ).first()
    assert hit / found >= 0.95 and hit / toxic >= 0.6


def test_sentiment_scores(rows):
    data = [(1, "good good bad"), (2, "bad awful"), (3, "good bad"), (4, "plain words"), (5, None)]
    df = rows(data, "post_id int, text string")
    got = {r.post_id: (r.sentiment_label, r.sentiment_score) for r in sentiment.score_sentiment(df).collect()}
    assert got == {
        1: ("Positive", 0.6), 2: ("Negative", 0.75), 3: ("Neutral", 1 / 3), 4: ("Neutral", 1.0), 5: ("Neutral", 1.0),
    }


def test_sentiment_reads_the_whole_text(rows):
    df = rows([(1, "word " * 5000 + "awful")], "post_id int, text string")
    assert sentiment.score_sentiment(df).first().sentiment_label == "Negative"


def test_own_models(rows):
    df = rows([(1, "abc"), (2, None)], "post_id int, text string")

    def load():
        return lambda texts: pd.DataFrame({"label": texts.str.upper(), "score": texts.str.len() * 1.0})

    got = {r.post_id: tuple(r.scored) for r in sentiment.score_with(df, load, "label string, score double").collect()}
    assert got == {1: ("ABC", 3.0), 2: ("", 0.0)}
    plain = sentiment.score_with(df, lambda: lambda texts: "[" + texts + "]", "string", output="js")
    assert {r.post_id: r.js for r in plain.collect()} == {1: "[abc]", 2: "[]"}


def test_models_are_loaded_once_per_worker(spark, rows, tmp_path):
    """Many tasks, few worker processes: a load leaves a file."""
    df = rows([(i, "x") for i in range(200)], "post_id int, text string").repartition(40)

    def load(folder=str(tmp_path)):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        return lambda texts: texts

    assert sentiment.score_with(df, load, "string").filter("scored = 'x'").count() == 200
    assert 1 <= len(list(tmp_path.iterdir())) <= 2 * spark.sparkContext.defaultParallelism


def test_trained_classifier(rows):
    data = [(f"sun joy light {i}", 1.0) for i in range(20)] + [(f"rain gloom dark {i}", 0.0) for i in range(21)]
    model = classifier.fit_text_classifier(rows(data, "text string, mood double"), "mood")
    test = rows([(1, "joy and sun"), (2, "gloom of rain"), (3, None)], "post_id int, text string")
    assert {r.post_id: r.prediction for r in classifier.classify(test, model).collect()} == {1: "1.0", 2: "0.0", 3: "0.0"}


def test_profiles_of_many_languages(rows):
    data = [(f"lang{i}", f"word{chr(97 + i % 26)}{chr(97 + i // 26)} " * 3) for i in range(600)]
    profile = language.fit_language_profile(rows(data, "language string, text string"))
    assert len(profile.languages) == 600
    got = language.detect_language(rows([(1, "wordcb"), (2, "wordzw")], "post_id int, text string"), profile)
    assert {r.post_id: r.language for r in got.collect()} == {1: f"lang{2 + 26}", 2: f"lang{25 + 22 * 26}"}


def test_semantic_keyphrases(docs):
    model = semantic.fit_word_vectors(docs, size=8, min_count=2)
    got = semantic.keywords_semantic(docs, model, n=2)
    assert got.groupBy("post_id").count().agg(F.max("count")).first()[0] == 2
    low, high = got.agg(F.min("score"), F.max("score")).first()
    assert -1.000001 <= low <= high <= 1.000001


def test_word_vectors_are_sums_of_hashed_signs(rows):
    """A word alone in its posts gets the signs of its own hash, in every block of 32 dimensions."""
    found = semantic.fit_word_vectors(rows([("zebra",), ("zebra",)], "text string"), size=72, min_count=2).first()
    parts = [int(hashlib.md5(b"zebra").hexdigest()[8 * k : 8 * k + 8], 16) for k in range(3)]
    assert found.word == "zebra"
    assert found.v == [2.0 * (1 - 2 * (parts[i // 32] >> i % 32 & 1)) for i in range(72)]


def test_only_chances_meet_their_frequencies(rows, monkeypatch):
    """Phrases beaten for certain are left out early; with few listed frequencies, which give wider bounds, the best are the same."""
    texts = {i: " ".join(f"w{i}x{k}" for k in range(40)) + " common" * 9 + f" rare{i}" * 7 + f" odd{i}" * 6 for i in range(9)}
    df = rows(list(texts.items()), "post_id int, text string")
    want = {(k, p) for k, top in brute_force_phrases(texts, 3, set(constants.STOP_WORDS)).items() for p, _ in top}
    for listed in (keyphrases.LISTED, 3):
        monkeypatch.setattr(keyphrases, "LISTED", listed)
        assert {(r.post_id, r.keyword) for r in keyphrases.top_phrases(df).collect()} == want
    stats = stage(keyphrases.phrase_stats(df), "stats")
    choose = keyphrases._may_be_best(3, stats, 9, 1)
    assert len(choose(Counter(texts[0].split()))) == 3


def test_common_items_are_not_shuffled(rows, monkeypatch):
    """A table over the limit meets its rows in two ways, with the same rows as by one join."""
    table = rows([(f"i{k}", {"a": -k, "b": -k - 1}) for k in range(9)], "item string, scores map<string,bigint>")
    posts = rows([(k % 4, f"i{k % 12}") for k in range(60)], "post_id int, item string")
    plain = bayes.with_scores(posts, table, "item", "scores")
    monkeypatch.setattr(bayes, "LISTED", 5)
    split = bayes.with_scores(posts, table, "item", "scores")
    by_row = lambda df: sorted((r.post_id, r.item, str(r.scores)) for r in df.collect())
    assert by_row(split) == by_row(plain)
    assert "BroadcastHashJoin" in split._jdf.queryExecution().toString()


def test_many_labels_are_summed_as_rows(rows, monkeypatch):
    posts = rows([(1, {"a": 1, "b": 3}), (1, {"a": 4, "b": 2}), (2, None), (3, {"a": 1, "b": 2})], "k int, s map<string,bigint>")
    found = []
    for wide in (64, 1):
        monkeypatch.setattr(bayes, "WIDE", wide)
        found.append({r.k: r.label for r in bayes.best_label(posts, "k", ["s"], {"a": 0, "b": 0}, "label", {"a": 0, "b": 0}).collect()})
    assert found[0] == found[1] == {1: "a", 2: "a", 3: "b"}


def test_rare_words_meet_their_vectors_by_a_join(docs, monkeypatch):
    few = docs.filter("post_id < 40")
    model = semantic.fit_word_vectors(few, min_count=2)
    by_row = lambda df: sorted((r.post_id, r["rank"], r.keyword, r.score) for r in df.collect())
    plain = by_row(semantic.keywords_semantic(few, model))
    monkeypatch.setattr(semantic, "LISTED", 20)
    assert by_row(semantic.keywords_semantic(few, model)) == plain


def test_repeated_keys_are_an_error(rows, profile):
    df = rows([(1, "apple banana cherry"), (1, "apple banana cherry")], "post_id int, text string")
    with pytest.raises(ValueError, match="unique"):
        enrich_posts(df, Resources(profile))


def test_chain(rows, profile, docs):
    extra = [(9001, None), (9002, "")]
    base = docs.select("post_id", "text").unionByName(rows(extra, "post_id bigint, text string"))
    done = enrich_posts(base, Resources(profile)).cache()
    assert done.count() == docs.count()
    assert done.filter((F.col("keywords") != "[]") & ~((F.col("language") == "en") & F.col("sfw"))).count() == 0
    assert done.filter(F.col("language") == "en").filter(F.col("keywords") != "[]").count() > 10
    legacy = enrich_legacy(base, Resources(profile))
    assert legacy.count() == docs.count() + 2
    assert legacy.agg(F.max(F.size("keywords")), F.min(F.size("keywords"))).first()[0] == 5


def test_wide_tables_are_not_broadcast(spark):
    """The planner's own measure counts all columns: 200 doubles a row make a big table of 20,000 rows."""
    wide = stage(spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.rand(1) + i).alias("v")), "wide")
    big = spark.range(1000).select(F.col("id").cast("string").alias("k"), "id")
    plan = joins.lookup(big, wide, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_skewed_lookup_is_whole(rows, broadcasts):
    """A third of the rows under one key."""
    big = rows([(i, "hot" if i % 3 == 0 else f"k{i}") for i in range(900)], "i int, k string")
    table = stage(rows([("hot", 1), *[(f"k{i}", i) for i in range(0, 900, 2)]], "k string, v int"), "dim")
    for how in ("left", "inner"):
        want = sorted(map(str, big.join(table, "k", how).select("i", "k", "v").collect()))
        assert sorted(map(str, joins.lookup(big, table, "k", how).collect())) == want


def test_word_vectors_of_any_size(rows):
    """No dimension beyond the first hash is constant, and words of like company lie closer than strangers."""
    pairs = [("cat", "purrs softly"), ("kitten", "purrs softly"), ("engine", "burns diesel"), ("motor", "burns diesel")]
    df = rows([(i, f"{w} {rest} {w}{i}") for i, (w, rest) in enumerate(pairs * 8)], "post_id int, text string")
    found = {r.word: r.v for r in semantic.fit_word_vectors(df, size=200).collect()}
    assert all(len(v) == 200 for v in found.values())
    words = [found[w] for w in ("cat", "kitten", "engine", "motor")]
    assert sum(len({v[i] for v in words}) > 1 for i in range(128, 200)) > 40

    def near(a, b):
        dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
        return dot(found[a], found[b]) / (dot(found[a], found[a]) * dot(found[b], found[b])) ** 0.5

    assert near("cat", "kitten") > max(near("cat", "engine"), near("kitten", "motor"))
    assert near("engine", "motor") > max(near("engine", "kitten"), near("motor", "cat"))
    small = {r.word: r.v for r in semantic.fit_word_vectors(df, size=32).collect()}
    assert all(found[w][:32] == small[w] for w in small)
