"""Duplicate pick (per folder) and newest version (per page) rules."""

import datetime as dt

from tidemark.operators import captures as C

SCHEMA = "archive string, seq bigint, domain string, rel_path string, capture_ts timestamp_ntz, size bigint"


def test_dedup_largest_then_shortest_path(spark):
    rows = [
        ("A", 1, "d", "x/en.html", None, 10), ("A", 2, "d", "x/en(1).html", None, 30), ("A", 3, "d", "x/en(1)(2).html", None, 20),
        ("A", 4, "d", "y/a.html", None, 5), ("A", 5, "d", "y/a(1).html", None, 5),
        ("B", 6, "d", "y/a(1).html", None, 5),
    ]
    got = sorted((r.archive, r.rel_path) for r in C.dedup_captures(spark.createDataFrame(rows, SCHEMA)).collect())
    # sizes differ -> largest keeps its own name; equal sizes -> shortest path; folders are separate
    assert got == [("A", "x/en(1).html"), ("A", "y/a.html"), ("B", "y/a(1).html")]


def test_latest_null_never_wins_and_ties_take_first_archive(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    rows = [
        ("A1", 1, "d", "p.html", t1, 1), ("A2", 2, "d", "p.html", None, 1), ("A3", 3, "d", "p.html", t2, 1),
        ("B2", 4, "d", "q.html", t2, 1), ("B1", 5, "d", "q.html", t2, 1),
        ("C2", 6, "d", "r.html", None, 1), ("C1", 7, "d", "r.html", None, 1),
    ]
    got = {r.rel_path: r.archive for r in C.latest_captures(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"p.html": "A3", "q.html": "B1", "r.html": "C1"}


def test_collision_numbering(spark):
    df = spark.createDataFrame([("A", 1, "d", "a/x.html"), ("A", 2, "d", "a/x.html"), ("A", 3, "d", "a/x.html.gz"),
                                ("A", 4, "d", "a/x.html.gz"), ("A", 5, "d", "a/noext"), ("A", 6, "d", "a/noext")],
                               "archive string, seq bigint, domain string, rel_path string")
    got = [r.rel_path for r in C.number_collisions(df, ["archive", "domain"], "rel_path", "seq").orderBy("seq").collect()]
    assert got == ["a/x.html", "a/x(1).html", "a/x.html.gz", "a/x.html(1).gz", "a/noext", "a/noext(1)"]


def test_fingerprint_sampled(spark):
    import hashlib

    small, big = b"a" * 100, bytes(range(256)) * 200  # 51,200 bytes -> sampled form
    df = spark.createDataFrame([(small, len(small)), (big, len(big))], "b binary, n bigint")
    got = [r[0] for r in df.select(C.fingerprint("b", "n")).collect()]
    n = len(big)
    sample = big[:8192] + big[n // 2: n // 2 + 8192] + big[-8192:]
    assert got == [hashlib.md5(small).hexdigest(), hashlib.md5(sample).hexdigest()]


def test_collision_numbering_across_buckets(spark):
    """A hot path spread over many order buckets numbers exactly like one window."""
    rows = [("A", i * 7, "d", "hot.html") for i in range(300)] + [("A", 5, "d", "cold.html"), ("B", 3, "d", "hot.html")]
    df = spark.createDataFrame(rows, "archive string, seq bigint, domain string, rel_path string")
    got = {(r.archive, r.seq): r.rel_path for r in C.number_collisions(df, ["archive", "domain"], "rel_path", "seq",
                                                                          bucket_width=16).collect()}
    assert got[("A", 0)] == "hot.html" and got[("A", 7)] == "hot(1).html" and got[("A", 299 * 7)] == "hot(299).html"
    assert got[("A", 5)] == "cold.html" and got[("B", 3)] == "hot.html"
    assert len(set(got.values())) == 302 - 1  # every hot row distinct, cold and B's hot.html share a name


def test_options_by_content_and_normalized_keys(spark):
    rows = [("A", 1, "d", "x.html", None, 5, b"aaaaa"), ("A", 2, "d", "x(1).html", None, 5, b"bbbbb"),
            ("A", 3, "d", "x(2).html", None, 5, b"aaaaa")]
    df = spark.createDataFrame(rows, SCHEMA + ", body binary")
    assert sorted(r.rel_path for r in C.dedup_captures(df).collect()) == ["x.html"]
    assert sorted(r.rel_path for r in C.dedup_captures(df, by_content=True).collect()) == ["x(1).html", "x.html"]
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    crawls = spark.createDataFrame([("A", 1, "d", "en.html", t1, 1), ("B", 2, "d", "en(1).html", t2, 1)], SCHEMA)
    assert sorted(r.rel_path for r in C.latest_captures(crawls).collect()) == ["en(1).html", "en.html"]
    assert [r.rel_path for r in C.latest_captures(crawls, normalize_keys=True).collect()] == ["en(1).html"]
