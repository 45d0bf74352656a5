"""URL, path and name expressions on hand-made edge rows."""

from pyspark.sql import functions as F

from tidemark.functions import urls as U
from tidemark.operators import captures as C


def _one(spark, col_fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_base_site_edges(spark):
    vals = ["http://uni.example/about/test.png", "https://www.uni.example:8080/x", "http://http://x.org/a", "dns:host.ch",
            "mailto:a@x", "https://www2.a.ch/", "https://www4.a.ch/", "uni.example/page", "https://a.ch./", "", None]
    got = _one(spark, U.base_site, vals)
    assert got == ["uni.example", "uni.example", "x.org", "host.ch", "a@x", "a.ch", "a.ch", "uni.example", "a.ch", None, None]


def test_base_url(spark):
    got = _one(spark, U.base_url, ["https://uni.example/de/about/test.html", "uni.example/x", "http://a.b"])
    assert got == ["https://uni.example", "uni.example/x", "http://a.b"]


def test_normalize_url_examples(spark):
    vals = ["https://uni.example/page.pdf", "https://uni.example/page.html", "https://uni.example/services/",
            "https://uni.example/index.html", "HTTPS://UNI.EXAMPLE/A?q=1#frag", "  ", None, "https://e.ch/x.html.html",
            "https://e.ch/a;params"]
    got = _one(spark, U.normalize_url, vals)
    assert got == ["https://uni.example/page", "https://uni.example/page", "https://uni.example/services", "https://uni.example",
                   "https://uni.example/a", None, None, "https://e.ch/x.html", "https://e.ch/a"]


def test_url_match_root_vs_page(spark):
    df = spark.createDataFrame([("https://uni.example", "https://uni.example/a/b"), ("https://uni.example/a/b", "https://uni.example"),
                                (None, "https://uni.example"), ("https://x.ch/a", "https://y.ch/b")], "a string, b string")
    got = [r[0] for r in df.select(U.urls_match(U.normalize_url("a"), U.normalize_url("b"))).collect()]
    assert got == [True, True, False, False]


def test_archive_path_rules(spark):
    df = spark.createDataFrame([("https://www.uni.example/de/about",), ("http://a.ch/x/y.z.html?q=1",),
                                ("http://a.ch",), ("http://a.ch/d.e/f%20g+h.php",)], "u string")
    host, d, f = U.archive_dir_and_file(F.col("u"))
    got = [tuple(r) for r in df.select(host, d, f).collect()]
    assert got == [("uni.example", "/de/about/", "index.html"), ("a.ch", "/x/", "y-z.html"),
                   ("a.ch", "/", "index.html"), ("a.ch", "/d-e/", "f g+h.php")]


def test_normalized_name_not_idempotent(spark):
    vals = ["sub/en(1).html", "sub/en(2).html", "sub/en.html", "index.html(1).gz", "en(1)(2).html", "((1)1).html"]
    got = _one(spark, C.normalized_name, vals)
    assert got == ["sub/en.html", "sub/en.html", "sub/en.html", "index.html.gz", "en.html", "(1).html"]


def test_capture_ts(spark):
    vals = ["ARCHIVEIT-4242-TEST-JOB77-0-SEED12-20250409125201867-00000-abcd.warc.gz",
            "X-2025130912520100-y", "X-2025040912520-y", "X-20250409125201-y", None]
    got = _one(spark, C.capture_ts, vals)
    assert [str(g) if g else None for g in got] == ["2025-04-09 12:52:01", None, None, "2025-04-09 12:52:01", None]


def test_media_params(spark):
    df = spark.createDataFrame([("Text/HTML; Charset=UTF-8",), ("a/b; x=1; y : 2; z",), (None,)], "c string")
    got = [(r[0], r[1]) for r in df.select(C.media_type("c"), C.media_params("c")).collect()]
    assert got[0] == ("text/html", {"charset": "utf-8"})
    assert got[1] == ("a/b", {"x": "1", "y": "2"})
    assert got[2] == (None, None)


def test_keep_query_option(spark):
    from tidemark.operators import captures as Cap

    df = spark.createDataFrame([("http://a.ch/x.php?id=1", "text/html", None), ("http://a.ch/x.php?id=2", "text/html", None),
                                ("http://a.ch/x.php", "text/html", None)],
                               "target_uri string, media_type string, content_encoding string")
    default = [r.rel_path for r in Cap.with_archive_path(df).collect()]
    assert default == ["x.html", "x.html", "x.html"]
    kept = [r.rel_path for r in Cap.with_archive_path(df, keep_query=True).collect()]
    assert len(set(kept)) == 3 and kept[2] == "x.html" and all(k.endswith(".html") for k in kept)


def test_capture_ts_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
        got = _one(spark, C.capture_ts, ["A-20240331023000123-B"])  # inside the local DST gap
        assert str(got[0]) == "2024-03-31 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
