"""Trend rows and the reports on them, on hand-written tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.text import language_name
from tidewatch.operators import trends
from tidewatch.plans import reports, trend_job
from tidewatch.schemas import KEYWORD_TRENDS, POSTS, TREND_KEY
from tidewatch.sinks import append, upsert
from tidewatch.sinks.tables import existing
from tidewatch.sources import views

DAY = ("2025-01-01 00:00:00", "2025-01-02 00:00:00")
NOON = datetime(2025, 1, 1, 12)


def post(post_id, keywords, score=0.5, label="Positive", at=NOON, **more):
    row = dict.fromkeys([f.name for f in POSTS.fields])
    return tuple({**row, "post_id": post_id, "did": "d", "keywords": keywords, "sentiment_score": score,
                  "sentiment_label": label, "created_at": at, **more}.values())


def trend(keyword, count, score=0.5, label="Positive", at=NOON):
    return (keyword, at, at, count, score, label)


@pytest.fixture
def posts(spark):
    return lambda *data: spark.createDataFrame(list(data), POSTS)


@pytest.fixture
def table(spark):
    return lambda *data: spark.createDataFrame(list(data), KEYWORD_TRENDS)


def test_distinct_posts_but_mean_over_occurrences(posts):
    df = posts(post(1, '[["a", 1], ["a", 2]]', 0.2), post(2, '[["a", 1]]', 0.8))
    for unique in (True, False):
        row = trends.keyword_trends(df, *DAY, unique_posts=unique).first()
        assert row.post_count == 2 and row.avg_sentiment_score == pytest.approx((0.2 + 0.2 + 0.8) / 3)


def test_missing_scores_do_not_count_in_the_mean(posts):
    df = posts(post(1, '[["a", 1]]', None), post(2, '[["a", 1]]', 0.8), post(3, '[["b", 1]]', None))
    got = {r.keyword: (r.post_count, r.avg_sentiment_score) for r in trends.keyword_trends(df, *DAY).collect()}
    assert got == {"a": (2, 0.8), "b": (1, None)}


def test_long_and_missing_keywords(posts):
    df = posts(
        post(1, f'[["{"x" * 100}", 1], ["{"y" * 101}", 1]]'), post(2, None), post(3, "[]"), post(4, "null"),
        post(5, "junk"), post(6, '[["a"], []]'), post(7, '[[null, 1]]'),
    )
    assert sorted(r.keyword for r in trends.keyword_trends(df, *DAY).collect()) == ["a", "x" * 100]


def test_period_is_half_open(posts):
    df = posts(post(1, '[["a", 1]]', at=datetime(2025, 1, 1)), post(2, '[["a", 1]]', at=datetime(2025, 1, 2)))
    row = trends.keyword_trends(df, *DAY).first()
    assert (row.post_count, row.period_start, row.period_end) == (1, datetime(2025, 1, 1), datetime(2025, 1, 2))


def test_hourly_rows_add_up_to_periods(spark, sf):
    df = views.posts_wide(spark, sf)
    hourly = trends.keyword_trends_hourly(df).groupBy("keyword", "sentiment_label").agg(F.sum("post_count").alias("n"))
    whole = trends.keyword_trends(df, "2024-01-01 00:00:00", "2024-02-01 00:00:00").select("keyword", "sentiment_label", "post_count")
    assert sorted(map(tuple, hourly.collect())) == sorted(map(tuple, whole.collect()))
    one = hourly.sparkSession.sql("SELECT timestamp'2024-01-03 04:00:00' a, timestamp'2024-01-03 05:00:00' b").first()
    single = trends.keyword_trends(df, one.a, one.b)
    again = trends.keyword_trends_hourly(df).filter(F.col("period_start") == F.lit(one.a))
    assert sorted(map(str, single.collect())) == sorted(map(str, again.collect()))


def test_unknown_flag_is_nsfw_and_unknown_language_is_one_group(posts):
    df = posts(post(1, None, sfw=None, language=None), post(2, None, sfw=True, language="unknown"), post(3, None, sfw=False, language="en"))
    assert dict(map(tuple, reports.sfw_totals(df, *DAY).collect())) == {"SFW": 1, "NSFW": 2}
    assert list(map(tuple, reports.language_totals(df, *DAY).collect())) == [("unknown", 2), ("en", 1)]


def test_dashboard_tells_null_labels_from_other_metrics(posts, table):
    df = posts(post(1, None, label=None), post(2, None))
    long = reports.dashboard_long(df, table(trend("a", 1)), *DAY)
    got = {tuple(r) for r in reports.slice_metric(long, "sentiment_totals").collect()}
    assert got == {(None, 1), ("Positive", 1)}
    assert {tuple(r) for r in reports.slice_metric(long, "posts_by_hour").collect()} == {(12, 2)}
    facts = dict(map(tuple, reports.slice_metric(long, "fast_facts").collect()))
    assert facts == {"TOTAL_POSTS": 2, "UNIQUE_USERS": 1, "UNIQUE_KEYWORDS": 1}


def test_dashboard_slices_equal_single_reports(spark, sf):
    df, span = views.posts_wide(spark, sf), ("2024-01-02 00:00:00", "2024-01-20 00:00:00")
    trend_rows = trends.keyword_trends_hourly(df)
    long = reports.dashboard_long(df, trend_rows, *span).cache()
    singles = {
        "posts_by_hour": reports.posts_by_hour(df, *span, closed="both"),
        "sentiment_totals": reports.sentiment_totals(df, *span),
        "sentiment_by_hour": reports.sentiment_by_hour(df, *span),
        "sfw_totals": reports.sfw_totals(df, *span),
        "language_totals": reports.language_totals(df, *span),
    }
    for metric, single in singles.items():
        got = reports.slice_metric(long, metric)
        assert got.columns == single.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, single.collect()))


def test_top_keywords_break_ties_by_name(table):
    df = table(trend("b", 5), trend("a", 5), trend("c", 5), trend("d", 9), trend("a", 0, label="Neutral"))
    assert [r.keyword for r in reports.top_keywords(df, *DAY, k=2).collect()] == ["d", "a"]
    assert [r.keyword for r in reports.top_keywords(df, *DAY, k=2, order="asc").collect()] == ["a", "d"]


def test_shares_are_null_without_known_labels(table):
    df = table(trend("a", 4, label="Mixed"), trend("b", 1), trend("b", 2, label="Neutral"))
    got = {r.keyword: r for r in reports.keyword_comparison(df, *DAY, ["a", "b"]).collect()}
    assert (got["a"].total_posts, got["a"].pct_positive, got["a"].pct_negative) == (4, None, None)
    assert (got["b"].pct_positive, got["b"].pct_neutral, got["b"].pct_negative) == (33.3, 66.7, 0.0)


def test_weighted_mean_and_keyword_list_or_table(table, rows):
    df = table(trend("a", 3, 0.5), trend("a", 1, 0.9, at=datetime(2025, 1, 1, 13)), trend("b", 1, 0.1))
    listed = reports.keyword_sentiment(df, *DAY, ["a"]).collect()
    assert [tuple(r) for r in listed] == [("a", "Positive", 4, 0.6)]
    assert reports.keyword_sentiment(df, *DAY, rows([("a",)], "keyword string")).collect() == listed
    assert reports.keyword_stats(df, *DAY, ["a"]).first().avg_sentiment_score == 0.6


def test_language_names(rows):
    df = rows([("en",), ("xx",), (None,), ("unknown",)], "c string")
    assert [r[0] for r in df.select(language_name(F.col("c"))).collect()] == ["English", "xx", None, "Unknown"]


def test_labels_and_folded_keywords(posts, table):
    df = trends.normalize_labels(posts(post(1, None, label="positive"), post(2, None, label="POSITIVE")))
    assert {r.sentiment_label for r in df.collect()} == {"Positive"}
    spelt = table(trend("Café", 1, 0.2), trend("cafe", 3, 0.6), trend("tea", 1))
    got = {r.keyword: (r.post_count, r.avg_sentiment_score) for r in trends.fold_keywords(spelt).collect()}
    assert len(got) == 2 and got["tea"] == (1, 0.5)
    [folded] = [v for k, v in got.items() if k != "tea"]
    assert folded == (4, pytest.approx(0.5))


def test_upsert_replaces_adds_and_keeps(table):
    old = table(trend("changed", 1), trend("vanished", 2))
    new = table(trend("changed", 7), trend("new", 3))
    once = upsert(old, new, TREND_KEY)
    assert {r.keyword: r.post_count for r in once.collect()} == {"changed": 7, "vanished": 2, "new": 3}
    assert sorted(map(str, upsert(once, new, TREND_KEY).collect())) == sorted(map(str, once.collect()))


def test_upsert_treats_null_keys_as_equal(table):
    rows = table(trend("a", 1, label=None), trend("a", 2))
    assert sorted(r.post_count for r in upsert(rows, rows, TREND_KEY).collect()) == [1, 2]


def test_stored_trends_survive_reruns_and_keep_other_days(spark, posts, tmp_path):
    path = str(tmp_path / "trends")
    other = ("2025-01-02 00:00:00", "2025-01-03 00:00:00")
    df = posts(
        post(1, '[["a", 1], ["b", 1]]'), post(2, '[["a", 1]]'), post(3, '[["a", 1]]', at=datetime(2025, 1, 2, 3)),
    )
    for period in (("2024-01-01 00:00:00", "2024-01-02 00:00:00"), DAY, other, DAY):  # the first one is empty
        trend_job.run(df, path, *period)
    changed = posts(post(1, '[["a", 1]]'), post(4, '[["c", 1]]'))
    trend_job.run(changed, path, *DAY)
    got = {(r.keyword, r.period_start.day): r.post_count for r in existing(spark, path, KEYWORD_TRENDS).collect()}
    assert got == {("a", 1): 1, ("b", 1): 1, ("c", 1): 1, ("a", 2): 1}


def test_append(spark, table, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        append(table(trend("a", n)), path)
    assert sorted(r.post_count for r in spark.read.parquet(path).collect()) == [1, 2]


def test_approximate_facts(posts, table):
    df, rows_ = posts(*[post(i, None, did=f"u{i % 50}") for i in range(200)]), table(trend("a", 1), trend("b", 1))
    row = reports.fast_facts(df, rows_, exact=False).first()
    assert row.total_posts == 200 and abs(row.unique_users - 50) <= 3 and row.unique_keywords == 2
