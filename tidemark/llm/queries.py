"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The url rules of the query (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import rule_table, url_verdicts

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_verdicts(pages, rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc_revisits import captures_of_pages, header_lines, resolve_revisits

    found = resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))
    return found.select("rec_id", "canonical", "ts", "base_id", "base_ts", "state", header_lines(F.col("headers")).alias("headers"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import count_of, joined, scan

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    s = F.col("secrets")
    return found.select(
        "doc_id", count_of(s, "assign").alias("n_assign"), count_of(s, "access").alias("n_access"), count_of(s, "hex").alias("n_hex"),
        F.sha2(joined(F.filter(s, lambda x: x["kind"] != "token")), 256).alias("base_sha256"), joined(s).alias("spans"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).drop("text")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, docs, table(spark, sf_dir, "labels")).drop("text")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import taken_words

    return taken_words(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_alignment import COLUMNS, align_documents

    found = align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select("doc_id", *COLUMNS, digest.alias("groups_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import periodic_runs, plant_repeats

    found = periodic_runs(plant_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.*", F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_dedup, op2_jaccard_join, op3_url_filter, op4_warc_revisits, op5_toxicity,
        op6_decontaminate, op7_secret_scan, op8_suffix_dedup, op9_quality, op10_packing,
        op11_source_mix, op12_token_alignment, op13_periodic_runs,
    )
}

_HOST = "translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op11_source_mix": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')) AS key,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rank % 3 + 1)::INTEGER] AS weight, 2 * source_size AS most, 2 * source_size / [5, 2, 1][(rank % 3 + 1)::INTEGER] AS level FROM s),
f AS (
  SELECT *, coalesce(sum(most) OVER b, 0)::BIGINT AS full_words, coalesce(sum(weight) OVER b, 0)::BIGINT AS full_weight,
         1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT AS wanted, (sum(weight) OVER ())::BIGINT AS weights
  FROM w WINDOW b AS (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (wanted - full_words) / (weights - full_weight) AS rest FROM f),
t AS (
  SELECT source, rank, source_size, least(most::DOUBLE, weight * coalesce((SELECT arg_min(rest, (level, rank)) FROM g WHERE rest <= level), 0)::DOUBLE) AS target
  FROM g),
line AS (
  SELECT r, size, floor(target)::BIGINT AS words,
         coalesce(sum(size) OVER (PARTITION BY rank ORDER BY turn, md5('11:' || turn || ':' || key), r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (1), (2)) AS v(turn)),
k AS (SELECT r, sum(greatest(0, least(pos + size, words) - pos))::BIGINT AS taken FROM line GROUP BY r)
SELECT doc_id, size::BIGINT AS size, source_size, target, taken FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN k USING (r)""",
    "op3_url_filter": f"""
WITH u AS (SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT u.*, (SELECT max((length(rhost) + length(rpath), rhost || rpath, rverdict)) FROM r
      WHERE (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)) AS best FROM u)
SELECT page_id, host, path, best[2] AS rule, coalesce(best[3], 'allow') AS verdict FROM m""",
    "op6_decontaminate": """
WITH w AS (
  SELECT doc_id, text, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM documents),
iw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(words, p, p + 12) AS win, least(len(words), 13) AS len
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS p FROM iw WHERE len(words) > 0)),
lens AS (SELECT DISTINCT len FROM win),
places AS (
  SELECT doc_id, p, len, list_slice(words, p, p + len - 1) AS win
  FROM (SELECT doc_id, words, len, unnest(range(1, len(words) - len + 2)) AS p FROM w, lens WHERE len(words) >= len)),
met AS (SELECT doc_id, p, places.len, item_id FROM places JOIN win USING (win)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + len)) AS pos FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_warc_revisits": r"""
WITH n AS (SELECT page_id, url, md5(coalesce(html, '')) AS md5, unnest(range(0, coalesce(page_id % 4, 0) + 1)) AS visit FROM pages),
rec AS (
  SELECT page_id * 4 + visit AS rec_id, url, (page_id * 7919) % 2592000 + visit * 86400 AS ts, visit, (page_id + visit) % 5 AS turn, page_id,
         md5, '"' || md5[1:16] || '"' AS tag, 'day ' || (page_id % 28) AS day FROM n),
v AS (
  SELECT rec_id, ts, visit,
         CASE WHEN url IS NULL THEN NULL
              WHEN regexp_matches(url, '^([^:/?#]+)://') THEN
                translate(regexp_extract(url, '^([^:/?#]+)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '://' ||
                regexp_replace(translate(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               CASE WHEN lower(url[1:5]) = 'https' THEN ':443$' ELSE ':80$' END, '') ||
                coalesce(nullif(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), ''), '/') ||
                regexp_extract(url, '^[^:/?#]+://[^/?#]*[^?#]*(\?[^#]*)', 1)
              ELSE regexp_replace(url, '#.*$', '') END AS canonical,
         CASE WHEN visit = 0 THEN CASE WHEN page_id % 7 <> 0 THEN tag END
              WHEN turn = 0 THEN tag WHEN turn = 1 THEN 'W/' || tag WHEN turn = 2 THEN '"changed"' END AS etag,
         CASE WHEN visit = 0 OR turn = 3 THEN day END AS modified,
         CASE WHEN visit = 0 OR turn = 0 THEN md5 END AS digest FROM rec),
base AS (SELECT canonical, (ts, rec_id) AS at_, rec_id AS base_id, ts AS base_ts, etag AS b_etag, modified AS b_modified, digest AS b_digest FROM v WHERE visit = 0),
pair AS (
  SELECT v.rec_id, v.canonical, v.ts, v.visit, max((base.base_ts, base.base_id)) AS b
  FROM v LEFT JOIN base ON base.canonical = v.canonical AND (base.base_ts, base.base_id) < (v.ts, v.rec_id) WHERE v.visit > 0 GROUP BY ALL),
judged AS (
  SELECT pair.rec_id, pair.canonical, pair.ts, pair.visit, b[2] AS base_id, b[1] AS base_ts,
         CASE WHEN pair.canonical IS NULL THEN 'no_url' WHEN b[2] IS NULL THEN 'no_base'
              ELSE CASE coalesce(regexp_replace(v.etag, '^W/', '') = b_etag, v.modified = b_modified, v.digest = b_digest)
                   WHEN true THEN 'resolved' WHEN false THEN 'mismatch' ELSE 'unverified' END END AS state
  FROM pair JOIN v USING (rec_id) LEFT JOIN base ON base.base_id = b[2])
SELECT rec_id, canonical, ts, base_id, base_ts, state,
       CASE WHEN state = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=' || (visit * 60), 'content-type: text/html', 'date: ' || ts, 'server: origin', 'x-cache: hit') END AS headers
FROM judged""",
}
