"""Archive records: header filters, census counts, digests, dead letters."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import captures as C

# Filters forced by content extraction, and media selections.
RESPONSE_ONLY = ["warc-type:response", "content-type:application/http"]
HTML_SELECTION = "http:content-type:text/html"
PDF_SELECTION = "http:content-type:pdf"


#: ``!`` (not), ``http:`` (headers of the HTTP message), key, value; what follows a further colon is ignored.
FILTER = re.compile(r"(?P<no>!)?(?P<http>http:)?+(?P<key>[^:]+):(?P<value>[^:]*)")


def _http_value(key: str) -> Column:
    """Header of the HTTP message, else the part of its start line or content type that the key names."""
    computed = {
        "status": "http_reason", "error": "http_status", "version": "http_version",
        "command": "http_command", "path": "http_path", "content_type": "media_type",
    }
    options = [F.col("http_headers")[key]]
    if key in computed:
        options.append(F.col(computed[key]))
    options.append(C.media_params(F.col("http_headers")["content-type"])[key])
    return F.when(F.col("http_headers").isNotNull(), F.coalesce(*options))


def filter_column(spec: str, case_sensitive: bool = False) -> Column:
    """The rows that one filter keeps: the header is there, not empty, and holds (or, with ``!``, lacks) the value."""
    m = FILTER.match(spec.lower())
    if not m:
        raise ValueError(f"filter needs key:value, got {spec!r}")
    found = _http_value(m["key"]) if m["http"] else F.col("warc_headers")[m["key"]]
    holds = F.contains(found if case_sensitive else F.lower(found), F.lit(m["value"]))
    return (F.length(found) > 0) & (~holds if m["no"] else holds)


def header_predicate(filters: list[str], case_sensitive: bool = False) -> Column:
    """AND of all filters as one Column (pushed into the same codegen stage)."""
    return reduce(Column.__and__, [filter_column(f, case_sensitive) for f in filters], F.lit(True))


def header_filter(records: DataFrame, filters: list[str], case_sensitive: bool = False) -> DataFrame:
    return records.where(header_predicate(filters, case_sensitive))


def response_only(records: DataFrame, selection: str | None = None) -> DataFrame:
    """Responses only, of one media selection if given (HTML_SELECTION, PDF_SELECTION)."""
    return header_filter(records, RESPONSE_ONLY + ([selection] if selection else []))


def record_census(records: DataFrame) -> DataFrame:
    """One pass: counts of records, by record type, by record content type, by HTTP
    media type (HTTP records), by status code (HTTP records), and by media types
    without a known suffix; null is a value."""
    is_http = F.col("http_headers").isNotNull()
    wct = C.media_type(F.col("warc_headers")["content-type"])
    pairs = F.array(
        F.struct(F.lit("records").alias("counter"), F.lit(None).cast("string").alias("value")),
        F.struct(F.lit("types").alias("counter"), F.col("warc_type").alias("value")),
        F.struct(F.lit("warc-content").alias("counter"), wct.alias("value")),
    )
    http_pairs = F.array(
        F.struct(F.lit("http-content").alias("counter"), F.col("media_type").alias("value")),
        F.struct(F.lit("status").alias("counter"), F.col("http_status").alias("value")),
    )
    strange = F.col("media_type").isNotNull() & C.default_suffix(F.col("media_type")).isNull()
    strange_pairs = F.array(F.struct(F.lit("unknown-media").alias("counter"), F.col("media_type").alias("value")))
    all_pairs = F.when(is_http & strange, F.concat(pairs, http_pairs, strange_pairs)).when(is_http, F.concat(pairs, http_pairs)).otherwise(pairs)
    return records.select(F.explode(all_pairs).alias("p")).groupBy("p.counter", "p.value").agg(F.count("*").alias("n"))


def payload_digests(records: DataFrame) -> DataFrame:
    """``sha1:`` digest of each payload, compared with the declared header."""
    digest = F.concat(F.lit("sha1:"), F.sha1(F.col("body")))
    declared = F.col("warc_headers")["warc-payload-digest"]
    return records.select(
        "archive", "offset", "record_id", "target_uri", F.col("warc_headers")["warc-ip-address"].alias("ip_address"),
        "warc_date", digest.alias("payload_digest"),
        F.when(declared.isNull(), F.lit(None).cast("boolean")).otherwise(F.lower(declared) == digest).alias("digest_ok"),
    )


def record_errors(records: DataFrame) -> DataFrame:
    """Dead letters: records the reader could not parse."""
    return records.where(F.col("error").isNotNull())


def ingest_summary(records: DataFrame) -> DataFrame:
    """Archives read cleanly vs with an error row."""
    per = records.groupBy("archive").agg(F.count_if(F.col("error").isNotNull()).alias("_e"))
    return per.groupBy((F.col("_e") == 0).alias("ok")).agg(F.count("*").alias("archives"))
