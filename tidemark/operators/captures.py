"""Captures: archive paths, suffixes, numbering, capture keys, duplicate pick, newest version.

The two selection steps (in-archive duplicate pick and newest version per
page) are aggregations with ``min_by`` over an ordering struct instead of
``row_number`` windows: Spark then combines map-side (partial aggregation), so
a page captured millions of times never lands whole in one task, and bodies
travel through the shuffle once per map task and key, not once per row.
"""

from __future__ import annotations

import mimetypes
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import urls as U

TS_PATTERN = r"-(\d{14})\d*-"


# ---------------------------------------------------------------- media types
def media_type(content_type: Column | str) -> Column:
    """``type`` part of a Content-Type value, lower-cased and trimmed."""
    c = F.col(content_type) if isinstance(content_type, str) else content_type
    return F.trim(F.split_part(F.lower(c), F.lit(";"), F.lit(1)))


def media_params(content_type: Column | str) -> Column:
    """Parameters of a Content-Type value as ``map<string,string>``.

    Each ``;`` part is split on ``[;:=]``; only parts with two or more pieces
    count; keys and values trimmed and lower-cased.
    """
    c = F.col(content_type) if isinstance(content_type, str) else content_type
    parts = F.slice(F.split(F.lower(c), ";"), 2, 1 << 20)
    pieces = F.transform(parts, lambda p: F.transform(F.split(F.trim(p), "[;:=]"), lambda x: F.trim(x)))
    pairs = F.transform(
        F.filter(pieces, lambda a: F.size(a) > 1), lambda a: F.struct(a[0].alias("key"), a[1].alias("value"))
    )
    return F.map_from_entries(F.aggregate(
        pairs,
        F.array().cast("array<struct<key:string,value:string>>"),
        # later duplicates win, as in a dict update
        lambda acc, kv: F.concat(F.filter(acc, lambda e: e["key"] != kv["key"]), F.array(kv)),
    ))


@lru_cache(maxsize=1)
def suffix_table_rows() -> tuple[tuple[str, str], ...]:
    """(media type, default suffix) pairs from the standard library's type registry."""
    types = set(mimetypes.types_map.values()) | set(mimetypes.common_types.values())
    rows = []
    for t in sorted(types):
        ext = mimetypes.guess_extension(t)
        if ext:
            rows.append((t, ext))
    return tuple(rows)


def suffix_table(spark: SparkSession) -> DataFrame:
    """Small fixed lookup table (a few hundred rows) for broadcast joins."""
    return spark.createDataFrame(list(suffix_table_rows()), "st_media_type string, st_suffix string")


# ---------------------------------------------------------------- paths
def repaired_file(stem: Column, ext: Column, suffix: Column) -> Column:
    """File name with the media type's default suffix; unknown type keeps its own."""
    return F.when(suffix.isNotNull(), F.concat(stem, suffix)).otherwise(F.concat(stem, F.lit("."), ext))


def number_collisions(df: DataFrame, keys: list[str], path_col: str, order_col: str,
                      bucket_width: int = 4096) -> DataFrame:
    """Same path again within ``keys`` -> ``(1)``, ``(2)``... before the last dot.

    Skew-safe ranking: records are ranked inside (group, order bucket) windows,
    where a bucket is a range of ``bucket_width`` positions; bucket counts per
    group are prefix-summed (at most one row per bucket, never a whole group) and
    joined back on (group, bucket).  A path fetched millions of times inside one
    archive is thus spread over many tasks, and the result equals a single
    ``row_number`` per group.
    """
    g = [*keys, path_col]
    bucket = F.floor(F.col(order_col) / F.lit(bucket_width))
    keyed = df.withColumn("_bk", bucket)
    w = Window.partitionBy(*g, "_bk").orderBy(order_col)
    local = keyed.withColumn("_r", F.row_number().over(w))
    # keys-only second pass with partial aggregation (no bodies travel here)
    counts = keyed.groupBy(*g, "_bk").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*g).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*g, "_bk", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    ranked = local.join(offsets, [*g, "_bk"])
    n = F.col("_off") + F.col("_r") - 1
    p = F.col(path_col)
    dot = F.length(p) - F.locate(".", F.reverse(p)) + 1
    has_dot = F.instr(p, ".") > 0
    numbered = F.when(n == 0, p).when(
        has_dot, F.concat(F.substring(p, F.lit(1), dot - 1), F.lit("("), n.cast("string"), F.lit(")"), F.substring(p, dot, 1 << 30))
    ).otherwise(F.concat(p, F.lit("("), n.cast("string"), F.lit(")")))
    return ranked.withColumn(path_col, numbered).drop("_bk", "_r", "_off")


def capture_ts(archive: Column | str) -> Column:
    """Capture time from an archive name (``-YYYYMMDDHHMMSS[mmm...]-``); bad -> null."""
    a = F.col(archive) if isinstance(archive, str) else archive
    d = F.nullif(F.regexp_extract(a, TS_PATTERN, 1), F.lit(""))
    part = lambda i, n: F.substring(d, i, n).cast("int")
    # built from its fields: no session time zone involved, invalid dates -> null
    return F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2), part(13, 2))


def folder_key(folder: Column | str) -> tuple[Column, Column]:
    """``{archive}_{domain}`` folder name -> (capture_ts, domain); no ``_`` -> nulls."""
    f = F.col(folder) if isinstance(folder, str) else folder
    has = F.instr(f, "_") > 0
    cut = F.length(f) - F.locate("_", F.reverse(f)) + 1
    archive = F.when(has, F.substring(f, F.lit(1), cut - 1))
    domain = F.when(has, F.substring(f, cut + 1, 1 << 30))
    return capture_ts(archive), domain


def normalized_name(rel_path: Column | str) -> Column:
    """Remove every ``(digits)`` from the file stem (directory and last suffix kept)."""
    p = F.col(rel_path) if isinstance(rel_path, str) else rel_path
    directory = F.regexp_extract(p, r"^(.*/)?[^/]*$", 1)
    name = F.regexp_extract(p, r"([^/]*)$", 1)
    # the suffix is the last dot-part unless the name starts with that dot only
    has_suffix = name.rlike(r"^.+\.[^.]*$") & ~name.rlike(r"^\.[^.]*$")
    stem = F.when(has_suffix, F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)).otherwise(name)
    suffix = F.when(has_suffix, F.regexp_extract(name, r"(\.[^.]*)$", 1)).otherwise(F.lit(""))
    return F.concat(directory, F.regexp_replace(stem, r"\(\d+\)", ""), suffix)


def fingerprint(body: Column | str, size: Column | str, chunk: int = 8192) -> Column:
    """md5 of the whole body under ``3*chunk`` bytes, else of first/middle/last chunk."""
    b = F.col(body) if isinstance(body, str) else body
    n = F.col(size) if isinstance(size, str) else size
    sampled = F.concat(
        F.substring(b, 1, chunk),
        F.substring(b, (n / 2).cast("int") + 1, chunk),
        F.substring(b, n - chunk + 1, chunk),
    )
    return F.when(n < 3 * chunk, F.md5(b)).otherwise(F.md5(sampled))


def default_suffix(media: Column) -> Column:
    """Default suffix of a media type from a constant map (no join: the table is
    fixed and small, so it is folded into the plan as one literal)."""
    pairs = [F.lit(x) for kv in suffix_table_rows() for x in kv]
    return F.try_element_at(F.create_map(*pairs), media) if pairs else F.lit(None).cast("string")


def with_archive_path(records: DataFrame, url_col: str = "target_uri", media_col: str = "media_type",
                      encoding_col: str = "content_encoding", keep_query: bool = False) -> DataFrame:
    """Add ``domain``, ``rel_path`` (before collision numbering) and ``suffix_known``.
    ``keep_query=True`` keeps URLs that differ only by query string apart."""
    parts = U.with_archive_path_parts(records, url_col, "_u", keep_query)
    stem = F.regexp_extract("_ufile", r"^(.*)\.[^.]*$", 1)
    ext = F.regexp_extract("_ufile", r"\.([^.]*)$", 1)
    out = (
        parts.withColumn("_suffix", default_suffix(F.col(media_col)))
        .withColumn("suffix_known", F.col("_suffix").isNotNull())
        .withColumn("_file", repaired_file(stem, ext, F.col("_suffix")))
        .withColumn("_file", F.when(F.col(encoding_col) == "gzip", F.concat("_file", F.lit(".gz"))).otherwise(F.col("_file")))
        .withColumn("domain", F.col("_uhost"))
        .withColumn("rel_path", F.concat(F.regexp_replace("_udir", "^/", ""), F.col("_file")))
        .drop("_uhost", "_udir", "_ufile", "_file", "_suffix")
    )
    return out


# ---------------------------------------------------------------- selection
def dedup_captures(captures: DataFrame, by_content: bool = False) -> DataFrame:
    """Within one capture folder (archive, domain) keep one file per normalized name:
    the largest; equal sizes -> the shortest, then smallest path.  The kept file
    keeps its own path.  ``by_content=True`` keeps one file per distinct content
    (fingerprint) instead of one per name."""
    cols = captures.columns
    order = F.struct(-F.col("size"), F.length("rel_path"), F.col("rel_path"))
    keyed = captures.withColumn("_norm", normalized_name("rel_path"))
    group = ["archive", "domain", "_norm"]
    if by_content:
        own = F.col("fingerprint") if "fingerprint" in cols else fingerprint(F.col("body").cast("binary"), F.col("size"))
        keyed = keyed.withColumn("_fp", own)
        group.append("_fp")
    picked = keyed.groupBy(*group).agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row")
    )
    return picked.select("_row.*")


def latest_captures(captures: DataFrame, normalize_keys: bool = False) -> DataFrame:
    """Newest version per (domain, rel_path); null times never win over a time;
    equal times -> smallest archive name.  ``normalize_keys=True`` treats
    ``en(1).html`` and ``en.html`` of different crawls as the same page."""
    cols = captures.columns
    ts_num = F.date_format("capture_ts", "yyyyMMddHHmmss").cast("bigint")
    order = F.struct(F.col("capture_ts").isNull(), -ts_num, F.col("archive"))
    key = normalized_name("rel_path") if normalize_keys else F.col("rel_path")
    picked = captures.groupBy("domain", key.alias("_key")).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row"))
    return picked.select("_row.*")


def allowed_pages(df: DataFrame, sites: DataFrame, domain_col: str = "domain", site_col: str = "domain") -> DataFrame:
    """Keep rows whose domain is in the allow list (left semi join)."""
    s = sites.select(F.col(site_col).alias("_site")).where(F.col("_site").isNotNull())
    return df.join(s, F.col(domain_col) == F.col("_site"), "left_semi")


def denied_pages(df: DataFrame, deny: list[str] | DataFrame, domain_col: str = "domain") -> DataFrame:
    """Drop rows whose domain is on the deny list (exact match)."""
    if isinstance(deny, DataFrame):
        d = deny.select(F.col(deny.columns[0]).alias("_deny"))
        return df.join(d, F.col(domain_col) == F.col("_deny"), "left_anti")
    return df.where(~F.col(domain_col).isin(list(deny)) | F.col(domain_col).isNull())


# ---------------------------------------------------------------- summaries
def domain_summary(pages_latest: DataFrame) -> DataFrame:
    """Files per domain plus a total row (domain null)."""
    return pages_latest.rollup("domain").agg(F.count("*").alias("files"))


def dup_counts(captures: DataFrame) -> DataFrame:
    """Removed duplicates per folder: sum over normalized-name groups of (size - 1)."""
    g = captures.groupBy("archive", "domain", normalized_name("rel_path").alias("norm")).agg(F.count("*").alias("n"))
    return g.groupBy("archive", "domain").agg(F.sum(F.col("n") - 1).alias("duplicates_removed"))
