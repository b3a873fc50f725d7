"""Selection, parsing and repair of incoming posts."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.constants import POST_TYPE
from tidewatch.functions import times
from tidewatch.operators import clean
from tidewatch.sinks import to_messages
from tidewatch.sources import select_posts

NOW = "2025-05-01 10:00:00"


def test_clamp_keeps_both_bounds(rows):
    stamps = ["2025-05-01 10:00:00", "2025-05-01 09:00:00", "2025-05-01 08:59:59.999999", "2025-05-01 10:00:00.000001", None]
    df = rows([(i, s) for i, s in enumerate(stamps)], "i int, s string").withColumn("created_at", F.col("s").cast("timestamp"))
    got = [r[0] for r in clean.clamp_created_at(df, NOW).orderBy("i").select("created_at").collect()]
    now = datetime(2025, 5, 1, 10)
    assert got == [now, datetime(2025, 5, 1, 9), now, now, now]


def test_clamp_defaults_to_now(rows):
    df = rows([("2020-01-01 00:00:00",)], "s string").select(F.col("s").cast("timestamp").alias("created_at"))
    [age] = clean.clamp_created_at(df).select(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("created_at")).first()
    assert age < 60


def test_offsets_need_the_lenient_mode(rows):
    df = rows([("2025-05-01T10:00:00+02:00",)], "createdAt string")
    assert clean.parse_created_at(df).first()[0] is None
    assert clean.parse_created_at(df, strict_z=False).first()[0] == datetime(2025, 5, 1, 8)


def test_layouts(rows):
    texts = ["junk", "", None, "2025-05-01T10:00:00.123456Z", "2025-05-01T10:00:00.123Z", "2025-05-01T10:00:00.1Z", "2025-05-01T10:00:00Z"]
    df = rows([(i, t) for i, t in enumerate(texts)], "i int, createdAt string")
    got = [r.created_at for r in clean.parse_created_at(df).orderBy("i").collect()]
    at = datetime(2025, 5, 1, 10)
    assert got == [
        None, None, None, at.replace(microsecond=123456), at.replace(microsecond=123000),
        at.replace(microsecond=100000), at,
    ]


def test_empty_text_is_dropped_and_blank_text_kept(rows):
    df = rows([(None,), ("",), (" ",), ("a",)], "text string")
    assert sorted(r.text for r in clean.drop_empty(df).collect()) == [" ", "a"]


def test_select_posts_and_rejects(rows):
    record = {"$type": POST_TYPE, "createdAt": "t", "text": "hello"}
    events = [
        {"did": "a", "commit": {"record": record}},
        {"did": "b", "commit": {}},
        {"did": "c"},
        {"did": "d", "commit": {"record": {**record, "$type": "other"}}},
        {"did": "e", "commit": {"record": {"$type": POST_TYPE}}},
        {"commit": {"record": record}},
    ]
    raw = rows([(json.dumps(e),) for e in events] + [("not json",), (None,)], "value string")
    posts, rejects = select_posts(raw)
    got = posts.orderBy("did").collect()
    assert [(r.did, r.createdAt, r.text) for r in got] == [("a", "t", "hello"), ("e", None, "")]
    assert rejects.count() == 6


def test_bad_json_gives_a_null_row(rows):
    got = clean.parse_messages(rows([("{oops",), ('{"did":"a"}',)], "value string")).collect()
    assert [(r.did, r.createdAt, r.text) for r in got] == [(None, None, None), ("a", None, None)]


def test_binary_payload(rows):
    got = clean.parse_messages(rows([(bytearray(b'{"did":"a","text":"x"}'),)], "value binary")).first()
    assert (got.did, got.text) == ("a", "x")


def test_messages_keep_nulls(rows):
    df = rows([("a", None, "café \"q\"")], "did string, createdAt string, text string")
    assert json.loads(to_messages(df).first().value) == {"did": "a", "createdAt": None, "text": "café \"q\""}


def test_post_key_is_stable_and_tells_contents_apart(rows):
    schema = "did string, createdAt string, text string"
    df = rows([("a", "t", "x"), ("a", "t", "x"), ("a", None, "x"), ("at", "", "x")], schema)
    keys = [r.post_key for r in clean.with_post_key(df).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 3
    assert clean.with_random_id(df).select("post_uuid").distinct().count() == 4


def test_ranges(rows):
    df = rows([("2025-01-01 00:00:00",), ("2025-01-02 00:00:00",)], "s string").select(F.col("s").cast("timestamp").alias("t"))
    bounds = ("2025-01-01 00:00:00", "2025-01-02 00:00:00")
    assert times.in_range(df, "t", *bounds).count() == 1
    assert times.in_range(df, "t", *bounds, closed="both").count() == 2


def test_lookback_floors_to_the_bucket(spark):
    start, end = times.lookback("2024-01-04 00:22:59")
    row = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    assert (row.s, row.e) == (datetime(2024, 1, 1, 0, 15), datetime(2024, 1, 4, 0, 15))


def test_round_seconds(rows):
    df = rows([("2025-01-01 00:00:00.5",), ("2025-01-01 00:00:00.499999",)], "s string")
    got = [r[0].second for r in df.select(times.round_seconds(F.col("s").cast("timestamp"))).collect()]
    assert got == [1, 0]


def test_hour_labels(spark):
    got = [r[0] for r in spark.range(24).orderBy("id").select(times.hour_label(F.col("id"))).collect()]
    assert (got[0], got[1], got[11], got[12], got[13], got[23]) == ("12 AM", "1 AM", "11 AM", "12 PM", "1 PM", "11 PM")


def test_dedup_picks_by_order(rows):
    df = rows([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], "k string, v int, t string")
    assert sorted(map(tuple, clean.dedup(df, ["k"], ["v"]).collect())) == [("a", 2, "y"), ("b", 5, "z")]
    assert sorted(map(tuple, clean.dedup(df, ["k"], ["v"], keep="first").collect())) == [("a", 1, "x"), ("b", 5, "z")]
    assert clean.dedup(df, ["k"], ["v"]).columns == ["k", "v", "t"]
