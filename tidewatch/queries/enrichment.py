"""Language, safety, sentiment, keyphrases, and the chains built from them."""

import pandas as pd
from pyspark.sql import functions as F

from tidewatch import constants
from tidewatch.functions.text import tokens
from tidewatch.operators import classifier, keyphrases, language, safety, semantic, sentiment, trends
from tidewatch.operators.incremental import assign_ids
from tidewatch.plans import reports
from tidewatch.plans.enrichment import Resources, enrich_posts
from tidewatch.plans.warehouse import load_increment
from tidewatch.queries.registry import END, START, query, sql_list, view
from tidewatch.queries.trends import printable
from tidewatch.session import stage
from tidewatch.sources import views

# The prose of the test tables is invented; these frequent words of it stand in for praise.
POSITIVE = constants.POSITIVE_WORDS + ("here", "only", "thing")
NEGATIVE = constants.NEGATIVE_WORDS

TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
WORDS = r"unnest(string_split(trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')), ' '))"
# Profiles learn from these posts, and every post is tagged.
TRAINING = "post_id % 5 <> 0"
CUTS = """
    CROSS JOIN unnest(range(1, length(w) + 3)) AS i(pos) CROSS JOIN unnest([1, 2, 3]) AS k(size)
    WHERE w <> '' AND pos + size - 1 <= length(w) + 2"""

view(
    "gram_counts",
    f"""SELECT language, substring('_' || w || '_', pos, size) AS gram, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT language, w, count(*) AS n FROM (SELECT language, {WORDS} AS w FROM posts_base WHERE {TRAINING}) GROUP BY ALL)
        {CUTS} GROUP BY ALL""",
    "posts_base",
)
view(
    "gram_totals",
    """SELECT language, sum(n) + (SELECT count(DISTINCT gram) FROM gram_counts) AS total
       FROM gram_counts GROUP BY language""",
    "gram_counts",
)
view(
    "gram_scores",
    """SELECT language, gram, CAST(round(ln((n + 1) / CAST(total AS DOUBLE)) * 1000000) AS BIGINT) AS lp
       FROM gram_counts JOIN gram_totals USING (language)""",
    "gram_totals",
)
view(
    "post_grams",
    f"""SELECT post_id, substring('_' || w || '_', pos, size) AS gram, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT post_id, w, count(*) AS n FROM (SELECT post_id, {WORDS} AS w FROM posts_base) GROUP BY ALL)
        {CUTS} GROUP BY ALL""",
    "posts_base",
)
view(
    "found_language",
    """SELECT post_id, arg_max(language, (score, -place)) AS language FROM (
           SELECT post_id, t.language, t.place,
                  sum(n * coalesce(lp, CAST(round(ln(1 / CAST(total AS DOUBLE)) * 1000000) AS BIGINT))) AS score
           FROM post_grams g
           CROSS JOIN (SELECT *, row_number() OVER (ORDER BY language) AS place FROM gram_totals) t
           LEFT JOIN gram_scores s ON s.gram = g.gram AND s.language = t.language
           GROUP BY ALL) GROUP BY post_id""",
    "post_grams",
    "gram_scores",
)
view(
    "tagged",
    f"""SELECT post_id, did, created_at, text, language, sfw,
               CASE WHEN p > n THEN 'Positive' WHEN n > p THEN 'Negative' ELSE 'Neutral' END AS sentiment_label,
               CASE WHEN p = n THEN 1 / (p + n + 1) ELSE (greatest(p, n) + 1) / (p + n + 2) END AS sentiment_score
        FROM (SELECT post_id, did, created_at, text, coalesce(f.language, 'unknown') AS language,
                     NOT list_has_any({TOKENS}, [{sql_list(constants.UNSAFE_WORDS)}]) AS sfw,
                     len(list_filter({TOKENS}, lambda x: x IN ({sql_list(POSITIVE)}))) AS p,
                     len(list_filter({TOKENS}, lambda x: x IN ({sql_list(NEGATIVE)}))) AS n
              FROM posts_base b LEFT JOIN found_language f USING (post_id) WHERE text <> '')""",
    "posts_base",
    "found_language",
)


def _phrase_views(name, source, condition, stop_words, n):
    """Views ``<name>_tf`` and ``<name>`` (post_id, rank, keyword, score) over the texts of a view."""
    view(
        f"{name}_tf",
        f"""SELECT post_id, phrase, count(*) AS tf FROM (
                SELECT post_id, unnest(list_concat(w, list_transform(range(1, len(w)),
                                                   lambda i: w[i] || ' ' || w[i + 1]))) AS phrase
                FROM (SELECT post_id, list_filter({TOKENS}, lambda x: x NOT IN ({sql_list(stop_words)})) AS w
                      FROM {source} WHERE {condition}))
            GROUP BY ALL""",
        source,
    )
    view(
        name,
        f"""SELECT post_id, CAST(place AS INTEGER) AS rank, phrase AS keyword, score FROM (
                SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, phrase) AS place
                FROM (SELECT post_id, phrase, round(tf * (ln(((SELECT count(*) FROM {source} WHERE {condition}) + 1)
                                                             / (df + 1)) + 1), 6) AS score
                      FROM {name}_tf JOIN (SELECT phrase, count(*) AS df FROM {name}_tf GROUP BY phrase)
                      USING (phrase)))
            WHERE place <= {n}""",
        f"{name}_tf",
    )


_phrase_views("phrases_all", "posts_base", "text <> ''", constants.STOP_WORDS, 3)
_phrase_views("phrases_legacy", "posts_base", "text <> ''", constants.ENGLISH_STOP_WORDS, 5)
_phrase_views("phrases_gated", "tagged", "language = 'en' AND sfw", constants.STOP_WORDS, 3)


def fitted(spark, sf, posts=None):
    """A profile of the training documents by their given language; ``posts`` are all of them, where a written table has them."""
    posts = views.posts_base(spark, sf) if posts is None else posts
    return language.fit_language_profile(posts.filter(TRAINING))


def resources(spark, sf):
    return Resources(fitted(spark, sf), positive=POSITIVE, negative=NEGATIVE)


# Scores of all n-grams, of frequent words as the sums over their n-grams, and of an n-gram never seen.
@query(
    f"""WITH cells AS (
            SELECT g.gram, t.language, coalesce(lp, CAST(round(ln(1 / CAST(total AS DOUBLE)) * 1000000) AS BIGINT)) AS score
            FROM (SELECT DISTINCT gram FROM gram_counts) g CROSS JOIN gram_totals t
            LEFT JOIN gram_scores s ON s.gram = g.gram AND s.language = t.language)
        SELECT 'item' AS kind, gram AS item, language, score FROM cells
        UNION ALL SELECT 'unseen', '', language, CAST(round(ln(1 / CAST(total AS DOUBLE)) * 1000000) AS BIGINT) FROM gram_totals
        UNION ALL SELECT 'word', w, language, CAST(sum(score) AS BIGINT)
        FROM (SELECT w, substring('_' || w || '_', pos, size) AS gram
              FROM (SELECT w FROM (SELECT {WORDS} AS w FROM posts_base WHERE {TRAINING}) GROUP BY w HAVING count(*) >= {language.READY_COUNT}) {CUTS})
        JOIN cells USING (gram) GROUP BY ALL""",
    "posts_base",
    "gram_scores",
)
def fit_language_profile(spark, sf):
    table = fitted(spark, sf).table
    return table.select("kind", F.coalesce("item", F.lit("")).alias("item"), F.explode("scores").alias("language", "score"))


@query(
    "SELECT post_id, coalesce(f.language, 'unknown') AS language FROM posts_base b LEFT JOIN found_language f USING (post_id)",
    "posts_base",
    "found_language",
)
def detect_language(spark, sf):
    return language.detect_language(views.posts_base(spark, sf), fitted(spark, sf)).select("post_id", "language")


@query(
    f"SELECT post_id, NOT list_has_any({TOKENS}, [{sql_list(constants.UNSAFE_WORDS)}]) AS sfw FROM posts_base",
    "posts_base",
)
def flag_sfw(spark, sf):
    return safety.flag_sfw(views.posts_base(spark, sf)).select("post_id", "sfw")


@query(
    f"""SELECT post_id, NOT list_has_any({TOKENS}, (SELECT list(DISTINCT word) FROM
               (SELECT unnest({TOKENS}) AS word FROM benchmark))) AS sfw
        FROM posts_base""",
    "posts_base",
)
def flag_sfw_by_table(spark, sf):
    """Posts that use any word of a word table."""
    listed = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.explode(tokens(F.col("text"))).alias("word"))
    return safety.flag_sfw(views.posts_base(spark, sf), listed).select("post_id", "sfw")


@query(
    f"""SELECT post_id, CASE WHEN p > n THEN 'Positive' WHEN n > p THEN 'Negative' ELSE 'Neutral' END AS sentiment_label,
               CASE WHEN p = n THEN 1 / (p + n + 1) ELSE (greatest(p, n) + 1) / (p + n + 2) END AS sentiment_score
        FROM (SELECT post_id, len(list_filter({TOKENS}, lambda x: x IN ({sql_list(POSITIVE)}))) AS p,
                     len(list_filter({TOKENS}, lambda x: x IN ({sql_list(NEGATIVE)}))) AS n FROM posts_base)""",
    "posts_base",
)
def score_sentiment(spark, sf):
    return sentiment.score_sentiment(views.posts_base(spark, sf), POSITIVE, NEGATIVE).select(
        "post_id", "sentiment_label", "sentiment_score"
    )


@query("SELECT * FROM phrases_all", "phrases_all")
def keyphrases_ranked(spark, sf):
    return keyphrases.top_phrases(views.posts_base(spark, sf)).select("post_id", "rank", "keyword", "score")


@query("SELECT phrase, count(*) AS df FROM phrases_all_tf GROUP BY phrase", "phrases_all_tf")
def phrase_document_frequency(spark, sf):
    return keyphrases.phrase_stats(views.posts_base(spark, sf))


def stored_phrases(df):
    """``post_id, rank, keyword, score`` read back from stored keyword JSON."""
    pairs = F.posexplode_outer(F.from_json("keywords", "array<array<string>>")).alias("at", "kv")
    return df.select("post_id", pairs).select(
        "post_id",
        (F.col("at") + 1).alias("rank"),
        F.get("kv", F.lit(0)).alias("keyword"),
        F.get("kv", F.lit(1)).cast("double").alias("score"),
    )


@query(
    "SELECT b.post_id, rank, keyword, score FROM posts_base b LEFT JOIN phrases_all USING (post_id)", "phrases_all"
)
def keywords_stored(spark, sf):
    return stored_phrases(keyphrases.keywords(views.posts_base(spark, sf)))


@query("SELECT post_id, rank, keyword FROM phrases_legacy", "phrases_legacy")
def keywords_legacy(spark, sf):
    named = keyphrases.keywords(
        views.posts_base(spark, sf), n=5, stop_words=constants.ENGLISH_STOP_WORDS, with_score=False
    )
    at = named.select("post_id", F.posexplode("keywords").alias("at", "keyword"))
    return at.select("post_id", (F.col("at") + 1).alias("rank"), "keyword")


TAGS = "post_id, did, language, sfw, sentiment_label, sentiment_score"


@query(
    f"SELECT {TAGS}, rank, keyword, score FROM tagged LEFT JOIN phrases_gated USING (post_id)", "phrases_gated"
)
def enrich_chain(spark, sf):
    done = enrich_posts(views.posts_base(spark, sf).drop("language"), resources(spark, sf))
    done = stage(done, "enriched")
    return done.select(*TAGS.split(", ")).join(stored_phrases(done), "post_id")


@query(
    f"""SELECT keyword, '{START}.000000' AS period_start, '{END}.000000' AS period_end,
               count(DISTINCT post_id) AS post_count, round(avg(sentiment_score), 6) AS avg_sentiment_score,
               sentiment_label
        FROM phrases_gated JOIN tagged USING (post_id) WHERE length(keyword) <= 100
        GROUP BY keyword, sentiment_label""",
    "phrases_gated",
)
def post_trends(spark, sf):
    """The flagship: raw text to keyword trends."""
    done = enrich_posts(views.posts_base(spark, sf).drop("language"), resources(spark, sf))
    return printable(trends.keyword_trends(done, START, END))


@query(
    """SELECT keyword, CAST(count(DISTINCT post_id) AS BIGINT) AS total_posts
       FROM phrases_gated WHERE length(keyword) <= 100
       GROUP BY keyword ORDER BY total_posts DESC, keyword LIMIT 20""",
    "phrases_gated",
)
def top_post_keywords(spark, sf):
    done = enrich_posts(views.posts_base(spark, sf).drop("language"), resources(spark, sf))
    return reports.top_keywords(trends.keyword_trends_hourly(done), START, END)


view(
    "kept_words",
    f"""SELECT row_number() OVER (ORDER BY word) AS keyword_id, word AS keyword_name
        FROM (SELECT DISTINCT unnest({TOKENS}) AS word FROM benchmark)""",
)
_phrase_views("phrases_fresh", "fresh_posts", "true", constants.ENGLISH_STOP_WORDS, 5)
view(
    "fresh_posts",
    """SELECT *, (SELECT count(*) FROM labels) + row_number() OVER (ORDER BY post_id) AS new_id
       FROM posts_base WHERE post_id NOT IN (SELECT doc_id FROM labels)""",
    "posts_base",
)
view(
    "fresh_words",
    """SELECT (SELECT max(keyword_id) FROM kept_words) + row_number() OVER (ORDER BY keyword) AS keyword_id,
              keyword AS keyword_name
       FROM (SELECT DISTINCT keyword FROM phrases_fresh
             WHERE keyword NOT IN (SELECT keyword_name FROM kept_words))""",
    "phrases_fresh",
    "kept_words",
)


def dimension_of_benchmark(spark, sf):
    """A keyword dimension that holds the words of the benchmark."""
    listed = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.explode(tokens(F.col("text"))).alias("keyword_name"))
    return assign_ids(listed.distinct(), "keyword_name", "keyword_id")


def _increment(spark, sf):
    """Labelled documents are loaded already, under ids 1..n; the dimension holds the benchmark's words."""
    done = views.labels(spark, sf).select(F.col("doc_id").alias("raw_post_id"))
    posts = assign_ids(done, "raw_post_id", "post_id")
    dim = dimension_of_benchmark(spark, sf)
    return load_increment(views.posts_base(spark, sf).drop("language"), posts, dim, resources(spark, sf))


@query(
    """SELECT new_id AS post_id, f.post_id AS raw_post_id, did, t.language, t.sfw, t.sentiment_label, t.sentiment_score
       FROM fresh_posts f JOIN (SELECT post_id, language, sfw, sentiment_label, sentiment_score FROM tagged) t
       USING (post_id)""",
    "fresh_posts",
    "tagged",
)
def load_new_posts(spark, sf):
    return _increment(spark, sf).posts.select(
        "post_id", "raw_post_id", "did", "language", "sfw", "sentiment_label", "sentiment_score"
    )


@query("SELECT * FROM fresh_words", "fresh_words")
def load_new_keywords(spark, sf):
    return _increment(spark, sf).keywords


@query(
    """SELECT new_id AS post_id, keyword_id
       FROM phrases_fresh JOIN fresh_posts USING (post_id)
       JOIN (SELECT * FROM kept_words UNION ALL SELECT * FROM fresh_words) d ON d.keyword_name = keyword""",
    "fresh_words",
)
def load_new_links(spark, sf):
    return _increment(spark, sf).post_keywords


def _length_model():
    """A stand-in for a real model: long texts against short ones."""

    def score(texts: pd.Series) -> pd.DataFrame:
        size = texts.str.len()
        return pd.DataFrame({"label": (size >= 280).map({True: "long", False: "short"}), "score": size / (size + 280.0)})

    return score


@query(
    """SELECT post_id, CASE WHEN length(text) >= 280 THEN 'long' ELSE 'short' END AS label,
              round(length(text) / (length(text) + 280.0), 6) AS score FROM posts_base""",
    "posts_base",
)
def score_with_model(spark, sf):
    scored = sentiment.score_with(views.posts_base(spark, sf), _length_model, "label string, score double")
    return scored.select("post_id", "scored.label", F.round("scored.score", 6).alias("score"))


@query(
    """SELECT post_id, '{"length": ' || length(text) || '}' AS scored FROM posts_base""", "posts_base"
)
def score_to_json(spark, sf):
    """A model that answers in JSON, a series for a series."""

    def load():
        return lambda texts: '{"length": ' + texts.str.len().astype(str) + "}"

    return sentiment.score_with(views.posts_base(spark, sf), load, "string").select("post_id", "scored")


@query(
    f"""WITH tok AS (SELECT post_id, unnest({TOKENS}) AS item FROM posts_base),
        known AS (SELECT doc_id AS post_id, toxic AS label FROM labels JOIN posts_base ON doc_id = post_id),
        counts AS (SELECT label, item, count(*) AS n FROM tok JOIN known USING (post_id) GROUP BY ALL),
        totals AS (SELECT label, sum(n) + (SELECT count(DISTINCT item) FROM counts) AS total FROM counts GROUP BY label),
        priors AS (SELECT label, CAST(round(ln(count(*) / CAST((SELECT count(*) FROM known) AS DOUBLE)) * 1000000) AS BIGINT) AS p
                   FROM known GROUP BY label),
        sums AS (
            SELECT post_id, label, p + coalesce((SELECT sum(CAST(round(ln((coalesce(c.n, 0) + 1) / CAST(total AS DOUBLE)) * 1000000) AS BIGINT))
                                                 FROM tok LEFT JOIN counts c ON c.item = tok.item AND c.label = totals.label
                                                 WHERE tok.post_id = b.post_id), 0) AS score
            FROM posts_base b CROSS JOIN totals JOIN priors USING (label))
        SELECT post_id, CAST(arg_max(label, (score, -label)) AS INTEGER) AS toxic FROM sums GROUP BY post_id""",
    "posts_base",
)
def classify_toxic(spark, sf):
    """Trained on the labelled posts, applied to all of them."""
    posts = views.posts_base(spark, sf)
    labelled = posts.join(views.labels(spark, sf).withColumnRenamed("doc_id", "post_id"), "post_id")
    model = classifier.fit_text_classifier(labelled, "toxic")
    return classifier.classify(posts, model).select("post_id", F.col("prediction").cast("int").alias("toxic"))


@query(
    f"""WITH w AS (SELECT post_id, list_filter({TOKENS}, lambda x: x NOT IN ({sql_list(constants.STOP_WORDS)})) AS ws FROM posts_base),
        once AS (SELECT DISTINCT post_id, unnest(ws) AS word FROM w),
        dims AS (SELECT unnest(range({semantic.SIZE})) AS i),
        base AS (SELECT word, ('0x' || substr(md5(word), 1, 8))::BIGINT AS b FROM (SELECT DISTINCT word FROM once)),
        company AS (SELECT post_id, i, sum(1 - 2 * ((b >> i) & 1)) AS v FROM once JOIN base USING (word), dims GROUP BY ALL),
        vectors AS (SELECT word, i, CAST(sum(v) AS DOUBLE) AS v FROM once JOIN company USING (post_id) GROUP BY ALL HAVING count(*) >= 5),
        whole AS (SELECT post_id, i, sum(v) AS v FROM (SELECT post_id, unnest(ws) AS word FROM w) JOIN vectors USING (word) GROUP BY ALL),
        parts AS (
            SELECT post_id, phrase, i, sum(v) AS v
            FROM (SELECT post_id, phrase, unnest(string_split(phrase, ' ')) AS word
                  FROM (SELECT DISTINCT post_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS phrase
                        FROM w)) JOIN vectors USING (word) GROUP BY ALL),
        scored AS (
            SELECT post_id, phrase, round(sum(p.v * d.v) / sqrt(sum(p.v * p.v) * sum(d.v * d.v)), 6) AS score
            FROM parts p JOIN whole d USING (post_id, i) GROUP BY ALL)
        SELECT post_id, CAST(place AS INTEGER) AS rank, phrase AS keyword, score
        FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, phrase) AS place FROM scored) WHERE place <= 3""",
    "posts_base",
)
def keyphrases_semantic(spark, sf):
    posts = views.posts_base(spark, sf)
    return semantic.keywords_semantic(posts, semantic.fit_word_vectors(posts)).select("post_id", "rank", "keyword", "score")
