"""The registered queries of this subpackage, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch import session
from tidewatch.llm import alignment, decontaminate, html, langid, licenses, neardup, periods, pieces, quality, secrets, sharding, substring, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The words of the contracts, for DuckDB.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session.configure(spark), sf_dir.rstrip("/"))

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS ws, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
    FROM (SELECT doc_id, unnest(ls) AS l FROM w) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
grams AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
    FROM (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
                 unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i : i + 2])) AS g FROM w WHERE len(ws) > 2)),
repeats AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM grams, (SELECT unnest(range(3)) AS k) WHERE n > 1 GROUP BY doc_id),
m AS (
    SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
           len(list_filter(ws, lambda x: regexp_matches(x, '[a-zA-Z]') OR strlen(x) > length(x))) AS n_letter_words
    FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND n_symbols <= n_words
       AND 10 * n_letter_words >= 6 * n_words AND 100 * n_dup_lines <= 50 * n_lines AS kept
FROM b
""")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


@query(f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
places AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth
    FROM (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i,
                 unnest(list_transform(range(1, len(ws) - 18), lambda i: array_to_string(ws[i : i + 19], ' '))) AS g
          FROM w WHERE len(ws) >= 20)),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM places, (SELECT unnest(range(20)) AS k) WHERE nth > 1),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


_PLAIN = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9[:^ascii:]]+')"


@query(f"""
WITH dw AS (SELECT doc_id, {_PLAIN} AS ws FROM documents WHERE text IS NOT NULL),
iw AS (SELECT min(item_id) AS item_id, ws, len(ws) AS n, least(5, len(ws)) AS size
       FROM (SELECT item_id, {_PLAIN} AS ws FROM benchmark WHERE text IS NOT NULL) WHERE len(ws) > 0 GROUP BY ws),
theirs AS (
    SELECT item_id, n, size, g, count(*) AS c
    FROM (SELECT item_id, n, size, unnest(list_transform(range(1, n - size + 2), lambda i: array_to_string(ws[i : i + size - 1], ' '))) AS g FROM iw)
    GROUP BY ALL),
own AS (
    SELECT doc_id, size, len(ws) - size + 1 AS all_g, unnest(range(len(ws) - size + 1)) AS i,
           unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i : i + size - 1], ' '))) AS g
    FROM dw, (SELECT DISTINCT size FROM iw) WHERE len(ws) >= size),
hits AS (SELECT *, n - size + 1 AS m, least(n - size + 1, all_g) AS width FROM own JOIN theirs USING (size, g)),
spots AS (SELECT doc_id, item_id, size, m, width, g, c, unnest(range(greatest(0, i - width + 1), least(i, all_g - width) + 1)) AS start FROM hits),
counted AS (SELECT doc_id, item_id, size, m, width, start, least(count(*), any_value(c)) AS k
         FROM spots GROUP BY doc_id, item_id, size, m, width, start, g),
alike AS (SELECT doc_id, item_id, sum(k) / (width + m - sum(k)) AS similarity, start, width + size - 1 AS n_words
          FROM counted GROUP BY doc_id, item_id, size, m, width, start HAVING sum(k) / (width + m - sum(k)) >= 0.8)
SELECT *, (SELECT count(DISTINCT item_id) FROM alike a WHERE a.doc_id = b.doc_id) AS n_items
FROM (SELECT * FROM alike QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id, start) = 1) b
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_NOTICES = ", ".join(f"({k}, '{name}', '{notice}')" for k, (name, notice) in enumerate(licenses.NOTICES))


@query(f"""
WITH notices(template, license, notice) AS (VALUES {_NOTICES}),
w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS ws FROM documents),
v AS (SELECT template, license, regexp_extract_all(lower(notice), '[\\p{{L}}\\p{{N}}]+') AS ws FROM notices),
theirs AS (SELECT DISTINCT template, license, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) AS g FROM v),
sizes AS (SELECT template, count(*) AS m, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS step FROM theirs GROUP BY template),
own AS (SELECT doc_id, unnest(range(len(ws) - 4)) AS i,
               unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) AS g FROM w WHERE len(ws) > 4),
hits AS (SELECT * FROM own JOIN theirs USING (g) JOIN sizes USING (template)),
spots AS (SELECT doc_id, template, license, m, i // step - back AS k, g, i FROM hits, (VALUES (0), (1)) b(back) WHERE i // step >= back),
windows AS (SELECT doc_id, license, m, count(DISTINCT g) AS n, min(i) AS i FROM spots GROUP BY doc_id, template, license, m, k)
SELECT doc_id, license, max(n / m) AS containment, min(i) AS first_word FROM windows WHERE n >= ceil(m * 0.8) GROUP BY doc_id, license
""")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count(table(spark, sf_dir, "documents"))


@query("""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
b AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bs FROM documents),
d AS (
    SELECT doc_id, len(bs) + 1 AS size,
           xor(list_reduce(list_prepend(4294967295::BIGINT, bs), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
           list_transform(range(9), lambda s: -1.0 / ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), 1, 13))::BIGINT::DOUBLE + 0.5)
                                                        / 4503599627370496.0)) AS scores
    FROM b, crc),
p AS (
    SELECT doc_id, size, text_crc32, list_position(scores[1:8], list_max(scores[1:8])) - 1 AS shard, list_position(scores, list_max(scores)) - 1 AS grown_shard,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || text_crc32 || ':' || size), 1, 8))::BIGINT
           % greatest(1, CAST(ceil((SELECT count(*) FROM documents) / 400000.0) AS BIGINT)) AS bucket
    FROM d)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot
FROM p
""")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query()
def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), variants=None).select(
        "doc_id", "n_pieces", "piece_ids", "lossless"
    )


@query()
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query(f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
    FROM documents),
sets AS (
    SELECT DISTINCT doc_id, g
    FROM (SELECT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 2, 2)), lambda i: array_to_string(ws[i : i + 3], ' '))) AS g
          FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS seen FROM w UNION SELECT b, seen FROM reach JOIN edges ON id = a)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(seen) AS component_id, w.doc_id = min(seen) AS kept
FROM w JOIN reach ON id = w.doc_id LEFT JOIN sizes ON sizes.doc_id = w.doc_id GROUP BY w.doc_id
""")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query()
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(table(spark, sf_dir, "documents"))
