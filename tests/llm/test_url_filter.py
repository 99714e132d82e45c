from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.llm.url_filter import allowed, keys_of, verdicts

T = datetime(2024, 1, 1)
DAY = timedelta(days=1)
CHANGES = [
    ("bad.example", "add", T), ("bad.example", "remove", T + 10 * DAY), ("bad.example", "add", T + 20 * DAY),
    ("sub.good.example/ads/", "add", T + 5 * DAY), ("BAD.example", "add", T + 1 * DAY),
    ("same.example", "add", T), ("same.example", "remove", T),
    (None, "add", T), ("x.example", None, T), ("y.example", "add", None), ("y.example", "remove", T),
]
CAPTURES = [
    (1, "http://bad.example/a", T), (2, "https://www.BAD.example:8080/?q=bad", T + 9 * DAY), (3, "http://bad.example", T + 10 * DAY),
    (4, "http://bad.example", T + 20 * DAY), (5, "http://notbad.example/", T + 1 * DAY), (6, "http://bad.example.org", T),
    (7, "http://sub.good.example/ads/x?y#z", T + 5 * DAY), (8, "http://sub.good.example/adsx", T + 6 * DAY),
    (9, "http://sub.good.example/ads", T + 6 * DAY), (10, "user@sub.good.example/ads//deep", T + 4 * DAY),
    (11, "http://same.example", T), (12, None, T), (13, "http://bad.example", None), (14, "", T), (None, "http://bad.example", T),
    (15, "http://a.b.bad.example./x", T + 30 * DAY), (15, "http://a.b.bad.example./x", T + 30 * DAY), (16, "http://y.example", T + DAY),
    (17, "not a url", T), (18, "http://bad.example", T - DAY),
]
BLOCKED = {1, 2, 4, 7, 9, 15, None}


@pytest.fixture
def frames(spark):
    captures = spark.createDataFrame([(*row, "z") for row in CAPTURES], "page_id long, url string, fetched_at timestamp_ntz, entry string")
    return captures, spark.createDataFrame(CHANGES, "entry string, action string, at timestamp_ntz")


def test_entries_active_at_fetch_time(frames):
    captures, changes = frames
    got = verdicts(captures, changes).collect()
    assert {row["page_id"] for row in got if row["blocked"]} == BLOCKED
    assert sum(row["rows"] for row in got) == len(CAPTURES)
    first = {row["page_id"]: (row["n_entries"], row["entry"]) for row in got}
    assert first[2] == (1, "bad.example") and first[7] == (1, "sub.good.example/ads") and first[3] == (0, None)
    assert first[15] == (1, "bad.example")


def test_allowed_captures(frames):
    captures, changes = frames
    kept = allowed(captures, changes)
    assert kept.columns == captures.columns
    want = Counter(row[0] for row in CAPTURES if row[0] not in BLOCKED)
    assert Counter(row["page_id"] for row in kept.collect()) == want


def test_nothing_listed_and_nothing_captured(frames):
    captures, changes = frames
    assert verdicts(captures, changes.limit(0)).filter("blocked").count() == 0
    assert verdicts(captures.limit(0), changes).count() == 0


def test_keys(spark):
    keys = spark.range(1).select(keys_of(F.lit("https://a.b.example/x/y/z?q=/no")).alias("k")).first()["k"]
    hosts = ["a.b.example", "b.example", "example"]
    assert sorted(keys) == sorted([*hosts, "a.b.example/x", "a.b.example/x/y", "a.b.example/x/y/z"])


def test_long_hosts_and_deep_paths(spark):
    host = ".".join(f"l{i}" for i in range(14)) + ".example"
    path = "/".join(f"s{i}" for i in range(12))
    captures = [
        (1, f"http://{host}/", T), (2, f"http://a.{host}/x", T), (3, f"http://deep.example/{path}/more?q", T),
        (4, f"http://deep.example/{path}x", T), (5, "http://deep.example/s0", T), (6, f"http://x{host}/", T),
    ]
    captures = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp_ntz")
    changes = spark.createDataFrame([(host, "add", T), (f"deep.example/{path}/", "add", T)], "entry string, action string, at timestamp_ntz")
    got = {row["page_id"]: (row["n_entries"], row["entry"]) for row in verdicts(captures, changes).filter("blocked").collect()}
    assert got == {1: (1, host), 2: (1, host), 3: (1, f"deep.example/{path}")}
    renamed = changes.withColumnRenamed("entry", "line")
    assert {row["page_id"] for row in allowed(captures, renamed, entry_col="line").collect()} == {4, 5, 6}
