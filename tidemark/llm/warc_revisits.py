"""Not-modified revisits resolved by an as-of join over the canonical url.

Records are swept in the order (canonical url, time, record id); each revisit sees
the last full response in front of it.  Only keys and validators travel through the
sweep; headers are joined to the resolved pairs by record id.  One url may hold any
share of the records: the sweep's ranges cut through it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_az, sorted_carry

# Header fields a 304 response may not change in a stored response
# (RFC 9111 section 3.2 and the hop-by-hop fields of RFC 9110 section 7.6.1).
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection",
    "te", "trailer", "transfer-encoding", "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Scheme and host lower-cased (A-Z), default port, fragment and an empty path normalised; null stays null."""
    parts = r"^([^:/?#]+)://([^/?#]*)([^?#]*)(\?[^#]*)?"
    whole = F.regexp_extract(url, parts, 0)
    scheme = lower_az(F.regexp_extract(url, parts, 1))
    host = lower_az(F.regexp_extract(url, parts, 2))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(
        scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.regexp_extract(url, parts, 3)
    path = F.when(path == "", "/").otherwise(path)
    return F.when(whole == "", F.regexp_replace(url, "#.*$", "")).otherwise(
        F.concat(scheme, F.lit("://"), host, path, F.regexp_extract(url, parts, 4)))


def _opaque(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit with the full response it confirms and the merged headers.

    ``records``: rec_id, url, ts, kind (``response`` or ``revisit``; others are
    ignored), etag, last_modified, digest, headers (map, names in lower case); more
    columns are ignored.  The base is the latest response of the same canonical url
    in front of the revisit by (ts, rec_id).  ``state``: ``resolved`` when the first
    validator that both have agrees (etag by weak comparison, then last-modified, then
    payload digest), ``mismatch`` when it differs, ``unverified`` when they share none,
    ``no_base`` without an earlier response, ``no_url`` for a null url.  Only resolved
    revisits get ``headers``: those of the base, overridden by what a 304 may change.
    Rows without rec_id are ignored; null times sort first. Repeated rows stay
    repeated; of different rows under one rec_id any one lends its headers."""
    records = records.filter("rec_id is not null")
    keyed = records.select("rec_id", canonical_url(F.col("url")).alias("canonical"), "ts", "kind", "etag", "last_modified", "digest")
    keyed = keyed.filter(F.col("kind").isin("response", "revisit"))
    full = F.when(
        F.col("kind") == "response",
        F.struct("canonical", F.col("rec_id").alias("base_id"), F.col("ts").alias("base_ts"), "etag", "last_modified", "digest"),
    )
    swept = sorted_carry(keyed.filter("canonical is not null").withColumn("full", full), ["canonical", "ts", "rec_id"], "full", "base", "revisits")
    revisits = swept.filter("kind = 'revisit'").withColumn("base", F.when(F.col("base.canonical") == F.col("canonical"), F.col("base")))
    agree = F.coalesce(
        _opaque(F.col("etag")) == _opaque(F.col("base.etag")),
        F.col("last_modified") == F.col("base.last_modified"),
        F.col("digest") == F.col("base.digest"),
    )
    state = F.when(F.col("base").isNull(), "no_base").when(agree, "resolved").when(~agree, "mismatch").otherwise("unverified")
    judged = revisits.select("rec_id", "canonical", "ts", F.col("base.base_id").alias("base_id"), F.col("base.base_ts").alias("base_ts"), state.alias("state"))
    lost = keyed.filter("kind = 'revisit' and canonical is null").select(
        "rec_id", "canonical", "ts", F.lit(None).cast(records.schema["rec_id"].dataType).alias("base_id"),
        F.lit(None).cast(records.schema["ts"].dataType).alias("base_ts"), F.lit("no_url").alias("state"))
    empty = F.create_map().cast("map<string,string>")
    own = records.filter("kind = 'revisit'").select("rec_id", F.coalesce("headers", empty).alias("__own")).dropDuplicates(["rec_id"])
    base = records.filter("kind = 'response'").select(F.col("rec_id").alias("base_id"), F.coalesce("headers", empty).alias("__base")).dropDuplicates(["base_id"])
    allowed = F.map_filter("__own", lambda k, v: ~k.isin(NOT_MERGED))
    kept = F.map_filter("__base", lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    merged = (
        judged.filter("state = 'resolved'").join(own, "rec_id").join(base, "base_id")
        .withColumn("headers", F.map_concat(kept, allowed))
        .select("rec_id", "canonical", "ts", "base_id", "base_ts", "state", "headers")
    )
    rest = judged.filter("state <> 'resolved'").unionByName(lost).withColumn("headers", F.lit(None).cast("map<string,string>"))
    return merged.unionByName(rest)


def header_lines(headers: Column) -> Column:
    """``name: value`` lines sorted by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl log derived from ``pages`` by a fixed recipe.

    Every page is fetched in full once, at a second of a 30-day span given by its id,
    and then visited ``page_id % 4`` more times, one day apart, each visit answered
    with 304.  Etag and last-modified of the full response come from the page's body;
    visits carry an equal, weak, changed or missing validator by ``(page_id + visit) % 5``.
    Pages of one url share its captures, so a visit may follow another page's response."""
    n = F.col("page_id")
    rows = pages.select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("md5"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.pmod(n, F.lit(4)), F.lit(0)).cast("bigint"))).alias("visit"),
    )
    turn = F.pmod(n + F.col("visit"), F.lit(5))
    etag = F.concat(F.lit('"'), F.substring("md5", 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), F.pmod(F.coalesce(n, F.lit(0)), F.lit(28)).cast("string"))
    first = F.col("visit") == 0
    rows = rows.select(
        (F.coalesce(n, F.lit(-1)) * 4 + F.col("visit")).alias("rec_id"), "url",
        (F.pmod(F.coalesce(n, F.lit(0)) * 7919, F.lit(2592000)) + F.col("visit") * 86400).alias("ts"),
        F.when(first, "response").otherwise("revisit").alias("kind"),
        F.when(first, F.when(F.pmod(n, F.lit(7)) != 0, etag)).when(turn == 0, etag).when(turn == 1, F.concat(F.lit("W/"), etag))
        .when(turn == 2, F.lit('"changed"')).alias("etag"),
        F.when(first | (turn == 3), modified).alias("last_modified"),
        F.when(first | (turn == 0), F.col("md5")).alias("digest"),
        "visit", "md5",
    )
    heads = F.map_concat(
        F.create_map(F.lit("date"), F.col("ts").cast("string"), F.lit("cache-control"), F.concat(F.lit("max-age="), (F.col("visit") * 60).cast("string"))),
        F.when(first, F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("server"), F.lit("origin")))
        .otherwise(F.create_map(F.lit("content-length"), F.lit("0"), F.lit("x-cache"), F.lit("hit"))),
    )
    return rows.withColumn("headers", heads)
