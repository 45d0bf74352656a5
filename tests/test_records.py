"""Archive reader on hand-made archives; header filters; census."""

import gzip
import os
import tempfile

import pytest

from tidemark.operators import records as Rec
from tidemark.sources import archives as A


def _record(uri, http: bytes, version="WARC/1.0", extra=b"") -> bytes:
    head = (f"{version}\r\nWARC-Type: response\r\nWARC-Target-URI: {uri}\r\nWARC-Date: 2025-01-01T00:00:00Z\r\n"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(http)}\r\n").encode() + extra + b"\r\n"
    return head + http + b"\r\n\r\n"


def _http(body: bytes, headers: str) -> bytes:
    return f"HTTP/1.1 200 OK\r\n{headers}\r\n".encode() + body


def _write(folder, name, data: bytes, gz=True):
    path = os.path.join(folder, name)
    with open(path, "wb") as fh:
        fh.write(data)
    return path


def test_reader_edges(spark):
    d = tempfile.mkdtemp(prefix="warc-test-")
    plain = _http(b"hello", "Content-Type: text/html\r\nContent-Length: 5\r\n")
    chunked = _http(b"5\r\nhello\r\n6\r\n world\r\n0\r\n\r\n", "Content-Type: text/html\r\nTransfer-Encoding: chunked\r\n")
    nolen = _http(b"all of it", "Content-Type: Text/HTML; charset=UTF-8\r\n")
    gzbody = gzip.compress(b"zipped page")
    zipped = _http(gzbody, f"Content-Type: text/html\r\nContent-Encoding: gzip\r\nContent-Length: {len(gzbody)}\r\n")
    members = b"".join(gzip.compress(_record(f"http://a.ch/{i}", h)) for i, h in enumerate([plain, chunked, nolen, zipped]))
    _write(d, "two-members.warc.gz", members)
    _write(d, "v11.warc", _record("http://b.ch/", plain, version="WARC/1.1"))
    _write(d, "bad-header.warc", _record("http://c.ch/", plain) + b"WARC/1.0\r\nno colon here\r\n\r\n")
    _write(d, "truncated.warc.gz", gzip.compress(_record("http://d.ch/", plain))[:-12])
    _write(d, "empty.warc", b"")
    _write(d, "ignored.txt", b"not an archive")
    files = A.archive_files(spark, d)
    # zero-byte files are skipped by Spark's file listing (nothing to read in them)
    assert sorted(r.name for r in files.collect()) == ["bad-header.warc", "truncated.warc.gz",
                                                      "two-members.warc.gz", "v11.warc"]
    recs = {(r.archive, r.offset): r for r in A.read_records(spark, d).collect()}
    ok = sorted(r.body for r in recs.values() if r.archive == "two-members.warc.gz")
    assert ok == sorted([b"hello", b"hello world", b"all of it", b"zipped page"])
    assert any(r.archive == "v11.warc" and r.body == b"hello" for r in recs.values())
    bad = [r for r in recs.values() if r.archive == "bad-header.warc"]
    assert len(bad) == 2 and sum(r.error is not None for r in bad) == 1
    assert [r.error is not None for r in recs.values() if r.archive == "truncated.warc.gz"] == [True]
    assert not [r for r in recs.values() if r.archive == "empty.warc"]


def test_reader_goes_on_behind_damage(spark):
    d = tempfile.mkdtemp(prefix="warc-test-")
    plain = _http(b"hello", "Content-Type: text/html\r\nContent-Length: 5\r\n")
    good = [_record(f"http://a.ch/{i}", plain) for i in range(6)]
    bad_header = b"WARC/1.0\r\nWARC-Type: response\r\nno colon here\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    no_footer = good[3][:-4]
    long_line = _record("http://a.ch/long", plain, extra=b"X-Long: " + b"y" * (3 << 20) + b"\r\n")
    _write(d, "plain.warc", good[0] + bad_header + good[1] + no_footer + good[2] + b"junk\r\n" + long_line + good[4])
    members = [gzip.compress(r) for r in good]
    broken = bytearray(members[2])
    broken[25:35] = b"\xff" * 10
    _write(d, "members.warc.gz", b"".join([*members[:2], bytes(broken), *members[3:]]))
    rows = A.read_records(spark, d).collect()
    uris = lambda name: [r.target_uri for r in rows if r.archive == name and r.error is None]
    assert sorted(uris("plain.warc")) == sorted(["http://a.ch/0", "http://a.ch/1", "http://a.ch/3", "http://a.ch/2", "http://a.ch/long", "http://a.ch/4"])
    assert set(uris("members.warc.gz")) >= {f"http://a.ch/{i}" for i in (0, 1, 3, 4, 5)}
    errors = [r for r in Rec.record_errors(A.read_records(spark, d)).collect() if r.archive == "plain.warc"]
    assert len(errors) == 2 and any("bad header line" in r.error and b"abc" in r.body for r in errors)
    assert any(r.error and r.archive == "members.warc.gz" for r in rows)


def test_start_lines_and_encodings(spark):
    d = tempfile.mkdtemp(prefix="warc-test-")
    _write(d, "a.warc", b"".join([
        _record("http://a.ch/0", b"HTTP/1.1 200\r\nContent-Type: text/html\r\n\r\nx"),
        _record("http://a.ch/1", b"HTTP/1.1 404 Not Found Here\r\n\r\nx"),
        _record("http://a.ch/2", b"GET /p?q HTTP/1.0\r\nHost: a\r\n\r\n"),
        _record("http://a.ch/3", b"HTTP/1.1 200 OK\r\nContent-Encoding: br\r\n\r\nraw"),
        _record("http://a.ch/4", b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot gzip"),
    ]))
    r = {x.target_uri[-1]: x for x in A.read_records(spark, d).collect()}
    assert (r["0"].http_status, r["0"].http_version, r["0"].http_reason) == ("200", "HTTP/1.1", "")
    assert (r["1"].http_status, r["1"].http_reason) == ("404", "Not Found Here")
    assert (r["2"].http_command, r["2"].http_path, r["2"].http_version, r["2"].http_status) == ("GET", "/p?q", "HTTP/1.0", None)
    assert "'br' is not supported" in r["3"].error and r["3"].body == b"raw" and r["4"].error and r["4"].body == b"not gzip"


def test_header_filter_semantics(spark):
    recs = spark.createDataFrame([
        ("response", {"warc-type": "response"}, {"content-type": "Text/HTML"}, "text/html", "200", "OK"),
        ("request", {"warc-type": "request"}, None, None, None, None),
        ("response", {"warc-type": "response", "x": ""}, {"content-type": "application/pdf"}, "application/pdf", "404", "Not Found"),
    ], "warc_type string, warc_headers map<string,string>, http_headers map<string,string>, media_type string, http_status string, http_reason string")
    f = lambda fs, **kw: recs.where(Rec.header_predicate(fs, **kw)).count()
    assert f(["warc-type:response"]) == 2
    assert f(["http:content-type:text/html"]) == 1            # mixed-case value matches by default
    assert f(["http:content-type:text/html"], case_sensitive=True) == 0
    assert f(["!http:error:200"]) == 1                         # request has no HTTP part -> fails
    assert f(["!x:anything"]) == 0                             # empty value fails even under '!'
    assert f(["!missing:v"]) == 0                              # '!' on a missing header fails
    assert f(["http:content_type:pdf"]) == 1                   # computed key
    assert f(["http:status:not found"]) == 1                   # the reason; the code is under error
    for bad in ["nokey", "http:status", ""]:
        with pytest.raises(ValueError):
            Rec.filter_column(bad)
    assert f(["warc-type:response:extra"]) == 2                # only the first two ':' parts count


def test_census_counts_nulls(spark, sf):
    from tidemark.sources import derived as S

    recs = S.warc_records(spark.read.parquet(f"{sf}/pages.parquet"))
    c = {(r.counter, r.value): r.n for r in Rec.record_census(recs).collect()}
    n_pages = spark.read.parquet(f"{sf}/pages.parquet").count()
    assert c[("records", None)] == 6 * n_pages
    assert c[("types", "response")] == c[("types", "request")] == 3 * n_pages


def test_warc_data_source_matches_reader(spark):
    d = tempfile.mkdtemp(prefix="warc-ds-")
    plain = _http(b"hello", "Content-Type: text/html\r\nContent-Length: 5\r\n")
    _write(d, "a.warc.gz", b"".join(gzip.compress(_record(f"http://a.ch/{i}", plain)) for i in range(3)))
    _write(d, "b.warc", _record("http://b.ch/", plain))
    A.register_warc_source(spark)
    via_ds = sorted((r.archive, r.offset, r.body) for r in spark.read.format("warc").load(d).collect())
    via_job = sorted((r.archive, r.offset, r.body) for r in A.read_records(spark, d).collect())
    assert via_ds == via_job and len(via_ds) == 4


def test_archive_round_trip_on_pages(spark, sf):
    from tidemark.sources import derived as S

    recs = S.warc_records(spark.read.parquet(f"{sf}/pages.parquet"))
    out = tempfile.mkdtemp(prefix="warc-rt-") + "/arch"
    n_arch = recs.select("archive").distinct().count()
    written = A.write_archives(recs, out, n_arch).collect()
    assert sum(r.records for r in written) == recs.count()
    back = A.read_records(spark, out)
    key = lambda r: (r.target_uri, r.warc_type, r.http_status, bytes(r.body) if r.body is not None else b"")
    want = sorted(key(r) for r in recs.select("target_uri", "warc_type", "http_status", "body").collect())
    got = sorted(key(r) for r in back.select("target_uri", "warc_type", "http_status", "body").collect())
    assert got == want
    assert back.where("error is not null").count() == 0
