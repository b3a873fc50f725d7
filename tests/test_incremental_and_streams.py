"""Incremental loads, sources, staging, and streams against the batch."""

import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidewatch import constants, session
from tidewatch.operators import clean, incremental, keyphrases, language, trends
from tidewatch.plans import load_job, selection_job, trend_job
from tidewatch.plans.enrichment import Resources, enrich_posts
from tidewatch.plans.warehouse import load_increment
from tidewatch.schemas import KEYWORDS, MESSAGE, STREAMED_POSTS
from tidewatch.sinks import publish, publish_stream, tables, to_messages, upsert_database, upsert_table, write_bucketed
from tidewatch.sources import read_message_stream, read_table, views
from tidewatch.sources.tables import jdbc_options
from tidewatch.sources import select_posts
from tidewatch.streaming import fold_late, run_enrichment, run_selection, run_trends
from tidewatch.streaming.late import keep_late, settled_until

DRAIN = {"availableNow": True}


def test_ids_are_consecutive_in_name_order(spark):
    names = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    got = incremental.assign_ids(names, "name", "id", after=7).orderBy("name").collect()
    assert [r.id for r in got] == list(range(8, 1008))


def test_dimension_grows_without_touching_old_ids(rows):
    dim = rows([(5, "b"), (9, "d")], "keyword_id bigint, keyword_name string")
    got = incremental.extend_dimension(dim, rows([("c",), ("a",), ("b",), ("c",)], "keyword_name string"))
    assert sorted(map(tuple, got.collect())) == [(10, "a"), (11, "c")]
    first = incremental.extend_dimension(rows([], KEYWORDS), rows([("z",)], "keyword_name string"))
    assert [tuple(r) for r in first.collect()] == [(1, "z")]


def test_loading_twice_adds_nothing(spark, sf):
    raw = views.posts_base(spark, sf)
    resources = Resources(language.fit_language_profile(raw))
    nothing = raw.limit(0).select(F.col("post_id"), F.col("post_id").alias("raw_post_id"))
    one = load_increment(raw.drop("language"), nothing, spark.createDataFrame([], KEYWORDS), resources)
    assert one.posts.count() == raw.count()
    assert one.post_keywords.join(one.keywords, "keyword_id").count() == one.post_keywords.count() > 0
    two = load_increment(raw.drop("language"), one.posts, one.keywords, resources)
    assert (two.posts.count(), two.keywords.count(), two.post_keywords.count()) == (0, 0, 0)


def test_lookup_ids(rows):
    got = incremental.lookup_ids(rows([("a",), ("b",)], "post_uuid string"), rows([("a", 1)], "post_uuid string, post_id int"))
    assert sorted(map(str, got.collect())) == ["Row(post_uuid='a', post_id=1)", "Row(post_uuid='b', post_id=None)"]


def test_read_table_formats(spark, rows, tmp_path):
    df = rows([(1, "a")], "i int, s string")
    for fmt in ("parquet", "json", "orc"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert [tuple(r) for r in read_table(spark, str(tmp_path / fmt), fmt, schema="i int, s string").collect()] == [(1, "a")]
    df.createOrReplaceTempView("some_table")
    assert read_table(spark, "some_table", "table").count() == 1


def test_jdbc_options():
    got = jdbc_options(
        "jdbc:x", "posts", partition_column="post_id", lower=1, upper=100, partitions=4, isolation_level="READ_COMMITTED"
    )
    assert got["partitionColumn"] == "post_id" and got["numPartitions"] == "4" and got["isolationLevel"] == "READ_COMMITTED"
    with pytest.raises(ValueError, match="partition_column"):
        jdbc_options("jdbc:x", "posts", partition_column="post_id")


def test_range_filter_reaches_the_scan(spark, sf):
    plan = trends.keyword_trends(views.posts_wide(spark, sf), "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_shuffles_are_sized_by_input(spark):
    conf = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.size_shuffles(spark, 100 << 40) == 409_600
        assert spark.conf.get(conf) == "409600"
        assert session.size_shuffles(spark, 1) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset(conf)


def test_staged_tables_are_removed_with_their_block(spark, tmp_path):
    import os

    with session.temporary_stages(spark):
        kept = session.stage(spark.range(5).toDF("i"), "t")
        [folder] = {os.path.dirname(f.removeprefix("file://")) for f in kept.inputFiles()}
        assert kept.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def write_messages(spark, sf, folder, part, parts):
    """One file of messages under ``folder``."""
    some = views.messages(spark, sf).filter(F.col("post_id") % parts == part)
    some.coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_over_a_restart(spark, sf, tmp_path):
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    schema = "post_id bigint, value string"

    def drain():
        stream = read_message_stream(spark, "parquet", source, 1, schema=schema)
        query = run_enrichment(stream, None, target, checkpoint, as_of="2024-01-02 12:00:00", trigger=DRAIN)
        query.awaitTermination()

    write_messages(spark, sf, source, 0, 3)
    write_messages(spark, sf, source, 1, 3)
    drain()
    drain()  # nothing new
    write_messages(spark, sf, source, 2, 3)
    drain()
    streamed = spark.read.parquet(target)
    batch = clean.clean_messages(views.messages(spark, sf), "2024-01-02 12:00:00")
    assert streamed.select("batch_id").distinct().count() == 3
    key = ["post_id", "did", "text", "created_at", "post_key"]
    assert sorted(map(str, streamed.select(key).collect())) == sorted(map(str, batch.select(key).collect()))


def test_rejected_events_are_kept(spark, sf, tmp_path):
    source, messages, rejects, checkpoint = (str(tmp_path / d) for d in ("in", "messages", "rejects", "checkpoint"))
    events = views.raw_events(spark, sf).select("value")
    events.repartition(2).write.parquet(source)
    stream = read_message_stream(spark, "parquet", source, 1)
    run_selection(stream, rejects, checkpoint, messages, "text", DRAIN).awaitTermination()
    posts, others = select_posts(events)
    assert sorted(map(str, spark.read.text(messages).collect())) == sorted(map(str, to_messages(posts).collect()))
    assert sorted(r.value for r in spark.read.parquet(rejects).collect()) == sorted(r.value for r in others.collect())


def test_the_feed_job_reads_and_writes_folders(spark, sf, tmp_path):
    source, messages, rejects, checkpoint = (str(tmp_path / d) for d in ("in", "messages", "rejects", "checkpoint"))
    events = views.raw_events(spark, sf).select("value")
    events.coalesce(1).write.text(source)
    where = ["--events", source, "--messages", messages, "--rejects", rejects, "--checkpoint", checkpoint, "--once"]
    for _ in range(2):  # the second time there is nothing new
        selection_job.main(where)
    posts, others = select_posts(events)
    assert sorted(map(str, spark.read.text(messages).collect())) == sorted(map(str, to_messages(posts).collect()))
    assert spark.read.parquet(rejects).count() == others.count()


def test_repeated_messages_are_stored_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    values = [(json.dumps({"did": "a", "createdAt": None, "text": t}),) for t in ("x", "x", "y")]
    for _ in range(2):
        spark.createDataFrame(values, "value string").coalesce(1).write.mode("append").parquet(source)
    seen = []

    def enrich(posts):
        seen.append(posts.count())
        return posts

    stream = read_message_stream(spark, "parquet", source, 1)
    run_enrichment(stream, enrich, target, checkpoint, as_of="2024-01-02 12:00:00", trigger=DRAIN).awaitTermination()
    stored = spark.read.parquet(target)
    assert sorted(r.text for r in stored.collect()) == ["x", "y"] and sorted(seen)[-1] == 2
    assert {"post_uuid", "post_date", "post_hour", "batch_id"} <= set(stored.columns)


def test_streamed_posts_reach_the_tables_and_the_trends(spark, rows, tmp_path):
    """Messages → staged posts → posts, keywords, links, twice; and → trends, by the jobs' own functions."""
    source, raw, tables, trend_path = (str(tmp_path / d) for d in ("in", "raw", "tables", "trends"))
    texts = ["good apple pie", "bad apple pie", "good pear"]
    values = [(json.dumps({"did": "a", "createdAt": None, "text": t}),) for t in texts]
    spark.createDataFrame(values, "value string").write.parquet(source)
    stream = read_message_stream(spark, "parquet", source)
    run_enrichment(stream, None, raw, str(tmp_path / "c"), as_of="2024-01-02 12:30:00", trigger=DRAIN).awaitTermination()
    resources = Resources(language.fit_language_profile(rows([("en", t) for t in texts] * 3, "language string, text string")))
    for _ in range(2):
        load_job.run(spark.read.parquet(raw), tables, resources)
    posts, words, links = (spark.read.parquet(f"{tables}/{t}") for t in ("posts", "keywords", "post_keywords"))
    assert sorted(r.post_id for r in posts.collect()) == [1, 2, 3] and words.count() == words.select("keyword_name").distinct().count()
    named = links.join(words, "keyword_id").join(posts, "post_id")
    assert {r.text for r in named.filter("keyword_name = 'apple'").collect()} == set(texts[:2])

    enriched = str(tmp_path / "enriched")
    run_enrichment(
        stream, lambda p: enrich_posts(p, resources, "post_key"), enriched, str(tmp_path / "c2"),
        as_of="2024-01-02 12:30:00", trigger=DRAIN,
    ).awaitTermination()
    at = ["--start", "2024-01-02 12:00:00", "--end", "2024-01-02 13:00:00", "--posts", enriched, "--trends", trend_path]
    for _ in range(2):
        trend_job.main(at)
    got = {(r.keyword, r.sentiment_label): r.post_count for r in spark.read.parquet(trend_path).collect()}
    assert got["apple", "Positive"] == got["apple", "Negative"] == 1 and got["pear", "Positive"] == 1
    scan = trend_job.in_days(read_table(spark, enriched, schema=STREAMED_POSTS), *at[1:4:2])
    assert "PartitionFilters: [isnotnull(post_date" in scan._jdf.queryExecution().executedPlan().toString()


def table_of(spark, path):
    return {(r.k, r.part): r.n for r in spark.read.parquet(path).collect()}


def test_an_upsert_rewrites_the_partitions_it_touches(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, part string, n int"
    upsert_table(rows([("a", "p1", 1), ("b", "p1", 1), ("c", "p2", 1), ("d", None, 1)], schema), path, ["k"], "part")
    untouched = sorted(f.name for f in (tmp_path / "t" / "part=p2").glob("*.parquet"))
    upsert_table(rows([("a", "p1", 2), ("e", "p3", 2), ("d", None, 2)], schema), path, ["k"], "part")
    upsert_table(rows([], schema), path, ["k"], "part")
    assert table_of(spark, path) == {("a", "p1"): 2, ("b", "p1"): 1, ("c", "p2"): 1, ("d", None): 2, ("e", "p3"): 2}
    assert untouched == sorted(f.name for f in (tmp_path / "t" / "part=p2").glob("*.parquet"))
    assert not (tmp_path / "t" / "_pending").exists()


def test_an_upsert_that_fails_before_its_copy_is_whole_changes_nothing(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, part string, n int"
    upsert_table(rows([("a", "p1", 1)], schema), path, ["k"], "part")

    @F.udf("int")
    def stop(n):
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        upsert_table(rows([("a", "p1", 2)], schema).withColumn("n", stop("n")), path, ["k"], "part")
    assert table_of(spark, path) == {("a", "p1"): 1}
    rows([("a", "p1", 9)], schema).write.parquet(f"{path}/_pending")  # files, but the job did not end
    (tmp_path / "t" / "_pending" / "_SUCCESS").unlink()
    upsert_table(rows([("b", "p1", 3)], schema), path, ["k"], "part")
    assert table_of(spark, path) == {("a", "p1"): 1, ("b", "p1"): 3}


def test_an_overwrite_that_fails_in_the_middle_is_done_again(spark, rows, tmp_path, monkeypatch):
    """Some partitions are new, one is gone; readers may see that until the next call, which has other rows, heals it."""
    import shutil

    path, schema = str(tmp_path / "t"), "k string, part string, n int"
    upsert_table(rows([("a", "p1", 1), ("b", "p2", 1), ("c", "p3", 1)], schema), path, ["k"], "part")
    whole = tables._replace

    def stop(merged, *where):
        whole(merged.filter("part = 'p1'"), *where)
        shutil.move(tmp_path / "t" / "part=p2", tmp_path / "gone")
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(tables, "_replace", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            upsert_table(rows([("a", "p1", 2), ("b", "p2", 2), ("x", "p2", 2)], schema), path, ["k"], "part")
    assert table_of(spark, path) == {("a", "p1"): 2, ("c", "p3"): 1}
    upsert_table(rows([("c", "p3", 3), ("x", "p2", 3)], schema), path, ["k"], "part")
    assert table_of(spark, path) == {("a", "p1"): 2, ("b", "p2"): 2, ("x", "p2"): 3, ("c", "p3"): 3}


def test_redone_batch_is_stored_once(spark, tmp_path):
    """A batch whose commit record is lost runs again and replaces its own folder."""
    source, target, checkpoint = (tmp_path / d for d in ("in", "out", "checkpoint"))
    value = json.dumps({"did": "a", "createdAt": None, "text": "x"})
    spark.createDataFrame([(value,)], "value string").write.parquet(str(source))

    def drain():
        stream = read_message_stream(spark, "parquet", str(source), 1)
        run_enrichment(stream, lambda df: df, str(target), str(checkpoint), trigger=DRAIN).awaitTermination()

    drain()
    (checkpoint / "commits" / "0").unlink()
    for crc in (checkpoint / "commits").glob(".0.crc"):
        crc.unlink()
    drain()
    assert spark.read.parquet(str(target)).count() == 1


def test_trend_stream_counts_a_repeated_post_once(spark, sf, tmp_path):
    source, path, checkpoint = (str(tmp_path / d) for d in ("in", "trends", "checkpoint"))
    events = views.events(spark, sf)
    for _ in range(2):
        events.coalesce(1).write.mode("append").parquet(source)
    posts = views.event_posts(read_message_stream(spark, "parquet", source, 1, schema=events.schema))
    run_trends(posts, path, checkpoint, delay="60 days", trigger=DRAIN, layout=trend_job.DAILY).awaitTermination()
    rounded = F.round("avg_sentiment_score", 9)
    got = spark.read.parquet(path).withColumn("avg_sentiment_score", rounded)
    want = trends.keyword_trends_hourly(views.event_posts(events)).withColumn("avg_sentiment_score", rounded)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_kafka_options_are_passed_on(spark):
    """The connector is not installed here, so only its absence can be seen."""
    with pytest.raises(Exception, match="(?i)kafka"):
        read_message_stream(spark, starting="earliest", max_per_trigger=0, **{"kafka.bootstrap.servers": "b:9092"})


def test_database_upsert_sends_every_row_once(rows, tmp_path):
    class FileConnection:
        """Stands in for a database: every transaction becomes a file."""

        def __init__(self, folder):
            self.folder, self.pending = folder, []

        def cursor(self):
            return self

        def executemany(self, sql, data):
            self.pending.append([sql, [[str(v) for v in row] for row in data]])

        def commit(self):
            (self.folder / f"{uuid.uuid4().hex}.json").write_text(json.dumps(self.pending))
            self.pending = []

        def close(self):
            assert not self.pending

    df = rows([(f"k{i}", i) for i in range(50)], "keyword string, post_count int")
    upsert_database(df, lambda: FileConnection(tmp_path), "keyword_trends", ["keyword"], writers=3, batch_size=7)
    sent = [entry for f in tmp_path.glob("*.json") for entry in json.loads(f.read_text())]
    assert {sql for sql, _ in sent} == {
        "INSERT INTO keyword_trends (keyword, post_count) VALUES (%s, %s) "
        "ON DUPLICATE KEY UPDATE post_count = VALUES(post_count)"
    }
    assert all(len(data) <= 7 for _, data in sent)
    assert sorted(tuple(r) for _, data in sent for r in data) == sorted((f"k{i}", str(i)) for i in range(50))


def test_published_messages_can_be_read_back(spark, rows, tmp_path):
    posts = rows([("a", "t", "x"), ("b", None, "y")], "did string, createdAt string, text string")
    publish(to_messages(posts), str(tmp_path / "batch"), "text")
    stream = spark.readStream.schema("value string").text(str(tmp_path / "batch"))
    again = to_messages(clean.parse_messages(stream))
    publish_stream(again, str(tmp_path / "c"), str(tmp_path / "stream"), "text", DRAIN).awaitTermination()
    got = clean.parse_messages(spark.read.text(str(tmp_path / "stream")))
    assert sorted(map(str, got.collect())) == sorted(map(str, posts.collect()))


def test_message_schema_matches_payload():
    assert MESSAGE.fieldNames() == ["did", "createdAt", "text"]


@pytest.fixture
def loading(spark, rows):
    """Raw posts by number, and resources whose phrase counts do not depend on a load."""
    texts = [f"apple pie{i} cherry{i % 3} soup{i % 5}" for i in range(30)]
    data = [(f"key{i:02d}", "a", "2024-01-01 00:00:00", t) for i, t in enumerate(texts)]
    raw = rows(data, "post_key string, did string, created_at string, text string")
    raw = session.stage(raw.withColumn("created_at", F.col("created_at").cast("timestamp")), "raw")
    labelled = rows([("en", t) for t in texts], "language string, text string")
    stats = session.stage(keyphrases.phrase_stats(labelled, stop_words=constants.ENGLISH_STOP_WORDS), "stats")
    return raw, Resources(language.fit_language_profile(labelled), stats=stats, documents=30)


def loaded(spark, path):
    """Everything but the random order of files: all rows of the three tables."""
    tables = {t: spark.read.parquet(f"{path}/{t}") for t in ("posts", "keywords", "post_keywords")}
    return {t: sorted(map(str, df.select(*sorted(df.columns)).collect())) for t, df in tables.items()}


@pytest.mark.parametrize("table,after", [("post_keywords", True), ("posts", False)])
def test_a_failed_load_is_done_again_with_its_own_ids(spark, loading, tmp_path, monkeypatch, table, after):
    """It stops before or after a table is written, other raw posts come, and the tables are those of loads that did not fail."""
    raw, resources = loading
    first, clean_path, path = raw.filter("post_key >= 'key10'"), str(tmp_path / "clean"), str(tmp_path / "failed")
    load_job.run(first, clean_path, resources)
    load_job.run(raw, clean_path, resources)
    write = load_job.Tables.write

    def stop(self, df, name, load):
        if after or name != table:
            write(self, df, name, load)
        if name == table:
            raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(load_job.Tables, "write", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            load_job.run(first, path, resources)
    load_job.run(raw, path, resources)
    load_job.run(raw, path, resources)  # nothing new
    assert loaded(spark, path) == loaded(spark, clean_path)
    links = spark.read.parquet(f"{path}/post_keywords")
    assert links.count() == links.select("post_id", "keyword_id").distinct().count() > 0
    assert sorted(r.post_id for r in spark.read.parquet(f"{path}/posts").collect()) == list(range(1, 31))


def test_a_ledger_that_was_not_written_to_its_end_does_not_count(spark, loading, tmp_path):
    raw, resources = loading
    path = str(tmp_path / "t")
    spark.createDataFrame([(99, "key00")], "post_id bigint, raw_post_key string").write.parquet(f"{path}/post_ids/load_id=1")
    (tmp_path / "t" / "post_ids" / "load_id=1" / "_SUCCESS").unlink()
    load_job.run(raw, path, resources)
    assert sorted(r.post_id for r in spark.read.parquet(f"{path}/posts").collect()) == list(range(1, 31))


def test_repeated_raw_keys_are_an_error_before_anything_is_written(loading, tmp_path):
    raw, resources = loading
    with pytest.raises(ValueError, match="not unique"):
        load_job.run(raw.union(raw), str(tmp_path / "t"), resources)
    assert not (tmp_path / "t").exists()


def test_late_posts_are_folded_in(spark, rows, tmp_path):
    """Posts one, three and thirty hours late, one of them delivered in time as well."""
    source, path, late, checkpoint = (str(tmp_path / d) for d in ("in", "trends", "late", "checkpoint"))
    schema = "post_id bigint, created_at timestamp, sentiment_label string, sentiment_score double, keywords string"

    def post(i, day, hour):
        at = datetime.datetime(2024, 1, day, hour, 10 + i % 50)
        return (i, at, "Positive" if i % 2 else "Neutral", i / 100, '[["word", 0.5], ["k%d", 0.4]]' % (i % 3))

    deliveries = [
        [post(i, 2, 8) for i in range(5)],
        [post(10, 2, 20), post(0, 2, 8)],  # the second is old, but nothing was known to be later before
        [post(20, 2, 19), post(21, 2, 17), post(22, 1, 14), post(23, 2, 20), post(1, 2, 8)],
        [post(30, 3, 2), post(31, 1, 14), post(22, 1, 14), (32, None, "Neutral", 0.5, None)],
    ]

    def drain():
        stream = read_message_stream(spark, "parquet", source, 1, schema=rows([], schema).schema)
        run_trends(stream, path, checkpoint, trigger=DRAIN, late=late).awaitTermination()

    def table():
        kept = spark.read.parquet(path).withColumn("avg_sentiment_score", F.round("avg_sentiment_score", 9))
        return sorted(map(str, kept.select(*trends.COLUMNS).collect()))

    def batch(posts):
        counted = trends.keyword_trends_hourly(posts.dropDuplicates(["post_id"]))
        return sorted(map(str, counted.withColumn("avg_sentiment_score", F.round("avg_sentiment_score", 9)).collect()))

    for some in deliveries[:3]:
        rows(some, schema).coalesce(1).write.mode("append").parquet(source)
        drain()
    everything = rows([p for some in deliveries[:3] for p in some], schema)
    assert table() != batch(everything)  # the stream alone lost some
    assert {r.post_id for r in spark.read.parquet(late).collect()} >= {21, 22}
    assert settled_until(spark, late) == datetime.datetime(2024, 1, 2, 18, 33)
    assert fold_late(everything, late, path) == 3
    assert table() == batch(everything)
    assert fold_late(everything, late, path) == 0
    rows(deliveries[3], schema).coalesce(1).write.mode("append").parquet(source)
    drain()
    everything = rows([p for some in deliveries for p in some], schema)
    on_time = everything.filter("post_id NOT IN (21, 22, 31)")  # a store without the late ones
    assert fold_late(on_time, late, path) > 0
    assert table() == batch(everything.filter("created_at IS NOT NULL"))


def test_a_repeated_micro_batch_keeps_its_late_posts_once(spark, rows, tmp_path):
    late, schema = str(tmp_path / "late"), "post_id bigint, created_at timestamp"
    posts = rows([(1, datetime.datetime(2024, 1, 2)), (2, datetime.datetime(2024, 1, 1))], schema)
    for batch_id in (0, 1, 1):
        keep_late(posts, late, batch_id, "2 hours")
    assert [r.post_id for r in spark.read.parquet(late).collect()] == [2]


def test_bucketed_tables_are_joined_where_they_lie(spark, rows, tmp_path):
    """Anti-join, join of ids and bridge: no exchange of either side, and the rows of plain tables."""
    posts = spark.range(1000).select(F.col("id").alias("post_id"), F.col("id").cast("string").alias("did"))
    done, ids = posts.filter("post_id % 3 = 0").select("post_id"), posts.select("post_id", (F.col("post_id") + 7).alias("stored_id"))
    name = f"t_{uuid.uuid4().hex}"
    stored = {k: write_bucketed(df, f"{name}_{k}", "post_id", 4, str(tmp_path / k)) for k, df in (("posts", posts), ("done", done), ("ids", ids))}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fresh = incremental.join_ids(incremental.unprocessed(stored["posts"], stored["done"], "post_id"), stored["ids"], "post_id")
        counted = fresh.groupBy("post_id").count()
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = incremental.join_ids(incremental.unprocessed(posts, done, "post_id"), ids, "post_id")
        assert sorted(map(str, fresh.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for k in stored:
            spark.sql(f"DROP TABLE {name}_{k}")
    assert len(list((tmp_path / "posts").glob("*.parquet"))) == 4
