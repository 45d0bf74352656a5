"""Inputs derived from the driver tables by fixed recipes.

The driver ships pages, documents, vectors and questions but no archives,
site sheets or relevance judgements.  These recipes derive them with Spark
from the given tables (their size grows with the tables); the oracle SQL in
``tidemark.plans.oracle`` restates every recipe for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import urls as U
from tidemark.operators import captures as C
from tidemark.session import materialise

CRAWLS = [0, 1, 2]


def _lpad2(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def archive_name(job: Column, crawl: Column) -> Column:
    """Archive file name of crawl ``crawl`` of job ``job``.

    Four jobs x three crawls; one crawl name has no timestamp, one a month 13,
    and two archives share a timestamp, so every branch of the capture key and
    of the newest-version rule is taken.
    """
    stamp = (
        F.when((job == 3) & (crawl == 2), F.lit("2024061"))
        .when((job == 2) & (crawl == 1), F.lit("20241315120000"))
        .when((job == 0) & (crawl == 2), F.lit("20240911120000"))
        .otherwise(F.concat(
            F.lit("2024"),
            _lpad2(1 + (crawl * 5 + job * 3) % 12),
            _lpad2(1 + (job * 7 + crawl * 3) % 28),
            _lpad2((job * 5 + crawl * 7) % 24),
            F.lit("0000"),
        ))
    )
    return F.concat(F.lit("ARCHIVEIT-1-JOB"), job.cast("string"), F.lit("-"), stamp, F.lit("000-00000-h.warc.gz"))


def response_records(pages: DataFrame) -> DataFrame:
    """Three crawls of every page as response records
    ``(archive, seq, target_uri, http_status, media_type, content_encoding, body)``.

    Body grows by a marker per version so sizes differ between crawls.  Some pages
    are PDFs or of an unknown type by their header, and some only redirect or are
    empty, so that every selection and status is met.
    """
    from tidemark.session import spread_for_cpu

    crawl = F.col("crawl")
    job = F.col("page_id") % 4
    k = F.col("page_id") + crawl
    page = (
        F.when(F.col("page_id") % 17 == 3, "<html><body><p>Redirecting</p></body></html>")
        .when(F.col("page_id") % 17 == 4, "<html><body> </body></html>").otherwise(F.col("html"))
    )
    return (
        spread_for_cpu(pages).select("page_id", "url", "html", F.explode(F.array(*[F.lit(c) for c in CRAWLS])).alias("crawl"))
        .select(
            archive_name(job, crawl).alias("archive"),
            (F.col("page_id") * 3 + crawl).alias("seq"),
            F.col("url").alias("target_uri"),
            F.when(F.col("page_id") % 7 == 0, "404").when(F.col("page_id") % 7 == 1, "301").otherwise("200").alias("http_status"),
            F.when(F.col("page_id") % 13 == 5, "application/pdf").when(F.col("page_id") % 13 == 9, "application/x-unknown")
            .otherwise("text/html").alias("media_type"),
            F.when(k % 5 == 0, F.lit("gzip")).alias("content_encoding"),
            F.concat(page, F.repeat(F.lit("<!-- v -->"), (k % 3).cast("int"))).alias("body"),
        )
    )


def capture_keys(records: DataFrame, bucket_width: int = 4096) -> DataFrame:
    """Capture table without bodies: archive path, collision numbering, capture time, size, fingerprint.

    Size and fingerprint are taken where the record is read, so no body goes through
    the numbering or any later selection."""
    size = F.octet_length("body").cast("bigint")
    slim = records.select(
        "archive", "seq", "target_uri", "http_status", "media_type", "content_encoding", size.alias("size"),
        C.fingerprint(F.col("body").cast("binary"), size).alias("fingerprint"))
    # numbering reads its input twice: the keys are written, so that records are read and hashed once
    slim = materialise(C.with_archive_path(slim), "capture-keys")
    numbered = C.number_collisions(slim, ["archive", "domain"], "rel_path", "seq", bucket_width)
    return numbered.select(
        "archive", "seq", "domain", "rel_path", C.capture_ts("archive").alias("capture_ts"),
        "media_type", "content_encoding", "size", "http_status", "fingerprint")


def with_bodies(captures: DataFrame, records: DataFrame) -> DataFrame:
    """The selected captures with their bodies: the one join that moves them."""
    return captures.join(records.select("archive", "seq", "body"), ["archive", "seq"])


def captures_from_pages(pages: DataFrame) -> DataFrame:
    return capture_keys(response_records(pages))


def captures_from_archives(records: DataFrame, selection: str | None = None) -> DataFrame:
    """Captures with bodies from the archive reader's records: responses only, of one media selection if given.

    A record's offset orders the records of its archive; collisions are numbered in
    buckets of 64 MB of it."""
    from tidemark.operators import records as Rec

    responses = Rec.response_only(records, selection).withColumnRenamed("offset", "seq")
    return with_bodies(capture_keys(responses, 64 << 20), responses)


def site_sheet(pages: DataFrame) -> DataFrame:
    """Allow-list sheet: column ``URL`` = page URL for even page ids, null otherwise;
    ``row`` keeps sheet order."""
    return pages.select(
        F.col("page_id").alias("row"),
        F.when(F.col("page_id") % 2 == 0, F.col("url")).alias("URL"),
    )


def site_list(sheet: DataFrame, url_col: str = "URL") -> DataFrame:
    """Distinct base sites of the non-empty sheet URLs."""
    u = F.col(url_col)
    return sheet.where(u.isNotNull() & (u != "")).select(U.base_site(u).alias("domain")).where(
        F.col("domain").isNotNull()).distinct()


def domain_map(sheet: DataFrame, url_col: str = "URL", order_col: str = "row") -> DataFrame:
    """Base site -> base URL, first sheet row wins."""
    u = F.col(url_col)
    return (
        sheet.where(u.isNotNull() & (u != ""))
        .select(U.base_site(u).alias("domain"), U.base_url(u).alias("base_url"), F.col(order_col).alias("_o"))
        .where(F.col("domain").isNotNull())
        .groupBy("domain").agg(F.min_by("base_url", "_o").alias("base_url"))
    )


def question_sheet(benchmark: DataFrame, pages: DataFrame) -> DataFrame:
    """Wide question sheet ``(Question, Relevant_Doc_1, Relevant Doc 2, row)``.

    Relevant page one is ``pages[(item*7) mod n]``; page two is
    ``pages[(item*13+3) mod n]`` written with ``www.`` and ``/index.html``;
    every tenth question has a blank second column.
    """
    n = pages.select(F.count("*")).scalar()
    p1 = pages.select(F.col("page_id").alias("p1"), F.col("url").alias("url1"))
    p2 = pages.select(F.col("page_id").alias("p2"), F.col("url").alias("url2"))
    q = benchmark.select(
        "item_id", "text",
        F.pmod(F.col("item_id") * 7, F.lit(n)).alias("p1"),
        F.pmod(F.col("item_id") * 13 + 3, F.lit(n)).alias("p2"),
    )
    www = F.regexp_replace(F.regexp_replace(F.col("url2"), r"[?#].*$", ""), r"/+$", "")
    www = F.concat(F.regexp_replace(www, r"^(https?://)(www\.)?", "$1www."), F.lit("/index.html"))
    return (
        q.join(p1, "p1", "left").join(p2, "p2", "left")
        .select(
            F.col("item_id").alias("row"),
            F.col("text").alias("Question"),
            F.col("url1").alias("Relevant_Doc_1"),
            F.when(F.col("item_id") % 10 == 9, F.lit("  ")).otherwise(www).alias("Relevant Doc 2"),
        )
    )


def expansions(benchmark: DataFrame, pages: DataFrame) -> DataFrame:
    """Stand-in for the expansion model's output: for items ``= 0 mod 3`` the question
    plus the title of its first relevant page, for ``= 1 mod 3`` an empty answer,
    else no row."""
    n = pages.select(F.count("*")).scalar()
    titled = pages.select(F.col("page_id").alias("p1"), F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("t"))
    q = benchmark.select("item_id", "text", F.pmod(F.col("item_id") * 7, F.lit(n)).alias("p1")).where(F.col("item_id") % 3 != 2)
    return q.join(titled, "p1", "left").select(
        F.col("item_id").alias("qid"),
        F.when(F.col("item_id") % 3 == 0, F.concat_ws(" ", "text", "t")).otherwise(F.lit("")).alias("expanded"),
    )


def warc_records(pages: DataFrame) -> DataFrame:
    """Archive records of the three crawls: a request and a response per page.

    Shape of the archive reader's output (``records``): lower-cased header maps,
    HTTP status and media type as columns.  Every third page declares its type
    as ``Text/HTML; charset=UTF-8`` (mixed case) to exercise header filters.
    """
    resp = response_records(pages).withColumn("page_id", F.floor(F.col("seq") / 3))
    ts = C.capture_ts("archive")
    ctype = F.when(F.col("media_type") != "text/html", F.col("media_type")).when(F.col("page_id") % 3 == 0, F.lit("Text/HTML; charset=UTF-8")).otherwise(F.lit("text/html; charset=utf-8"))
    http_resp = F.map_from_arrays(
        F.array(F.lit("content-type"), F.lit("content-encoding")),
        F.array(ctype, F.col("content_encoding")),
    )
    base = resp.select(
        "archive", "seq", "target_uri", "http_status", "body", "content_encoding", "page_id",
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("warc_date"), ctype.alias("ctype"), http_resp.alias("hh"))

    reason = F.when(F.col("http_status") == "404", "Not Found").when(F.col("http_status") == "301", "Moved Permanently").otherwise("OK")

    def rec(kind: str, offset: int) -> DataFrame:
        is_resp = kind == "response"
        wct = "application/http; msgtype=" + kind
        return base.select(
            "archive",
            (F.col("seq") * 2 + offset).alias("offset"),
            F.lit(kind).alias("warc_type"),
            F.concat(F.lit("<urn:rec:"), F.col("archive"), F.lit(":"), (F.col("seq") * 2 + offset).cast("string"), F.lit(">")).alias("record_id"),
            "warc_date",
            "target_uri",
            F.map_from_arrays(
                F.array(F.lit("warc-type"), F.lit("warc-target-uri"), F.lit("content-type"), F.lit("warc-date")),
                F.array(F.lit(kind), F.col("target_uri"), F.lit(wct), F.col("warc_date")),
            ).alias("warc_headers"),
            (F.col("http_status") if is_resp else F.lit(None).cast("string")).alias("http_status"),
            (reason if is_resp else F.lit(None).cast("string")).alias("http_reason"),
            F.lit("HTTP/1.1").alias("http_version"),
            F.lit(None if is_resp else "GET").cast("string").alias("http_command"),
            (F.lit(None).cast("string") if is_resp else F.regexp_extract("target_uri", r"^[^:]*://[^/?#]*([^#]*)", 1)).alias("http_path"),
            (F.col("hh") if is_resp else F.create_map(F.lit("host"), U.url_host(F.col("target_uri")))).alias("http_headers"),
            (C.media_type(F.col("ctype")) if is_resp else F.lit(None).cast("string")).alias("media_type"),
            (F.col("body").cast("binary") if is_resp else F.lit(None).cast("binary")).alias("body"),
            F.lit(None).cast("string").alias("error"),
        )

    return rec("request", 0).unionByName(rec("response", 1))
