"""Look-backs from roll-ups against the posts themselves."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.times import in_range, lookback
from tidewatch.plans import reports, rollups
from tidewatch.schemas import POST_DATE, POST_HOUR
from tidewatch.sources import views

START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("rolled")
    posts = views.posts_wide(spark, sf)
    rollups.store_rollup(posts, f"{folder}/rollups", START, END)
    laid_out = posts.withColumns({POST_DATE: F.to_date("created_at"), POST_HOUR: F.hour("created_at")})
    laid_out = laid_out.filter(F.col("created_at").between("2024-01-03 20:00:00", "2024-01-09 10:00:00"))  # of other hours no post is read
    laid_out.repartition(POST_DATE, POST_HOUR).write.partitionBy(POST_DATE, POST_HOUR).parquet(f"{folder}/posts")
    return spark.read.parquet(f"{folder}/posts"), rollups.read_rollup(spark, f"{folder}/rollups")


RANGES = [
    ("2024-01-04 13:22:31", "2024-01-09 07:41:05"),
    ("2024-01-04 13:00:00", "2024-01-04 15:00:00"),
    ("2024-01-04 13:10:00", "2024-01-04 13:50:00"),
    ("2024-01-04 13:59:59.999999", "2024-01-04 14:00:00"),
    ("2024-01-04 13:30:00", "2024-01-04 14:30:00"),
    ("2024-01-09 00:00:00", "2024-01-04 00:00:00"),
    ("2024-01-01 00:00:00", "2024-01-09 06:00:00"),
    lambda: lookback("2024-01-08 09:22:00"),
]


@pytest.mark.parametrize("bounds", RANGES)
def test_any_range_is_that_of_the_posts(spark, sf, stored, bounds):
    bounds = bounds() if callable(bounds) else bounds
    posts = views.posts_wide(spark, sf)
    trends = spark.createDataFrame([], "keyword string")
    want = reports.dashboard_long(posts, trends, *bounds).filter("metric <> 'fast_facts'")
    got = rollups.dashboard_lookback(*stored, *bounds)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    row = rollups.distinct_users(*stored, *bounds).first()
    inside = in_range(posts, "created_at", *bounds, closed="both")
    exact = inside.select("did").distinct().count()
    assert row.num_posts == inside.count()
    assert abs(row.unique_users - exact) <= 4 * rollups.SKETCH_ERROR * exact + 0.5


def test_two_hours_of_posts_are_read(stored):
    posts, rolled = stored
    edges = rollups.edges(posts, *RANGES[0])
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and POST_HOUR in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = [f for r in edges.select(F.input_file_name().alias("f")).distinct().collect() for f in [r.f]]
    assert {tuple(f.split("/")[-3:-1]) for f in files} <= {
        ("post_date=2024-01-04", "post_hour=13"), ("post_date=2024-01-09", "post_hour=7"),
    }
    hours = rollups.whole_hours(rolled, *RANGES[0])._jdf.queryExecution().executedPlan().toString()
    assert "period_day" in hours.split("PartitionFilters: [")[1].split("]")[0]


def test_rolling_up_again_replaces_the_hours(spark, rows, tmp_path):
    schema = "did string, created_at timestamp, sentiment_label string, sfw boolean, language string"
    at = datetime.datetime(2024, 1, 1, 5, 30)
    first = [("a", at, "Neutral", True, "en"), ("b", at, "Positive", None, None), ("c", at.replace(hour=6), "Neutral", True, "en")]
    path = str(tmp_path / "t")
    bounds = ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    rollups.store_rollup(rows(first, schema), path, *bounds)
    again = [("a", at, "Neutral", True, "en"), ("z", at, "Neutral", True, "en"), ("y", None, "Neutral", True, "en")]
    for _ in range(2):
        rollups.store_rollup(rows(again, schema), path, *bounds)
    got = {(r.period_start.hour, r.label, r.flag, r.lang): r.n for r in rollups.read_rollup(spark, path).collect()}
    assert got == {(5, "Neutral", "SFW", "en"): 2, (6, "Neutral", "SFW", "en"): 1}


def test_sketches_of_many_users(spark):
    """A hundred thousand users over ten hours, each of them in two."""
    ids = spark.range(100_000)
    posts = ids.select(
        F.col("id").cast("string").alias("did"), F.explode(F.array(F.col("id") % 10, (F.col("id") + 1) % 10)).alias("h")
    ).select(
        "did", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("h").cast("int"))).alias("created_at"),
        F.lit("Neutral").alias("sentiment_label"), F.lit(True).alias("sfw"), F.lit("en").alias("language"),
    )
    rolled = rollups.hourly_rollup(posts)
    row = rollups.distinct_users(posts, rolled, "2024-01-01 00:00:00", "2024-01-02 00:00:00").first()
    assert row.num_posts == 200_000 and abs(row.unique_users - 100_000) <= 4 * rollups.SKETCH_ERROR * 100_000
