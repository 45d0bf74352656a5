"""URL filters by a sort-merge range join over reversed-host keys.

A host becomes its labels in reverse, each ended by a dot (``a.example.net`` ->
``net.example.a.``).  A rule's host and all its subdomains are then exactly the
keys with the rule key as prefix: the interval from ``net.example.`` up to
``net.example/`` (``/`` follows ``.``).  Host intervals nest, so a sweep over
interval starts, ends and hosts in key order needs only the innermost open rule
host; the rules of its ancestors come with it as a stack.  The url's path then
picks the longest rule of that stack.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_az, sorted_carry

RULE_SCHEMA = "host string, path string, verdict string"


def url_host(url: Column) -> Column:
    """Host of a url: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return lower_az(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """Path of a url: behind the host up to ``? #`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _stacks(rules: DataFrame) -> DataFrame:
    """One row per rule host: its key, its nearest enclosing rule host, and the rules of both it and all that enclose it."""
    hosts = rules.groupBy("host").agg(
        F.collect_set(F.struct(F.length("host").alias("hl"), "path", "verdict", F.concat("host", "path").alias("rule"))).alias("own")
    )
    labels = F.split("host", r"\.")
    suffixes = hosts.select(
        "host",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        ).alias("outer"),
    )
    outer = hosts.select(F.col("host").alias("outer"), "own")
    return suffixes.join(outer, "outer").groupBy("host").agg(
        F.flatten(F.collect_list("own")).alias("stack"),
        F.max_by(F.when(F.col("outer") != F.col("host"), F.col("outer")),
                 F.when(F.col("outer") != F.col("host"), F.length("outer"))).alias("parent"),
    )


def url_verdicts(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row (same-named input columns are replaced).

    A rule (host, path, verdict) fits its host and all subdomains when the url's
    path starts with the rule's; the longest rule text wins, of equal ones the
    longer host, and of one rule with both verdicts ``block``.  Null urls and urls
    without ``://`` have an empty host and path and get ``default``, as does every
    url that no rule fits; rules with a null part are ignored; repeated rows stay; very long
    urls are taken whole.  No urls give no rows, and without rules all get ``default``."""
    rules = rules.dropna(subset=["host", "path", "verdict"]).select(lower_az(F.col("host")).alias("host"), "path", "verdict").distinct()
    stacks = _stacks(rules)
    urls = urls.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})
    key = host_key(F.col("host"))
    starts = stacks.select(key.alias("key"), F.lit(1).alias("turn"), F.lit(None).cast("string").alias("host"),
                           F.struct(F.col("host").alias("node")).alias("opened"))
    ends = stacks.select(F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit("/")).alias("key"), F.lit(0).alias("turn"), F.lit(None).cast("string").alias("host"),
                         F.struct(F.col("parent").alias("node")).alias("opened"))
    # each host is swept once, however many urls it has
    hosts = urls.select("host").distinct().select(
        key.alias("key"), F.lit(2).alias("turn"), "host", F.lit(None).cast("struct<node:string>").alias("opened"))
    swept = sorted_carry(starts.unionByName(ends).unionByName(hosts), ["key", "turn"], "opened", "active", "url-sweep")
    found = (
        swept.filter("turn = 2 and active.node is not null")
        .select("host", F.col("active.node").alias("node"))
        .join(stacks.select(F.col("host").alias("node"), "stack"), "node")
        .select("host", F.col("stack").alias("__stack"))
    )
    best = F.array_max(
        F.transform(
            F.filter("__stack", lambda r: F.col("path").startswith(r["path"])),
            lambda r: F.struct(F.length(r["rule"]).alias("n"), r["hl"].alias("hl"), r["verdict"].alias("verdict"), r["rule"].alias("rule")),
        )
    )
    return (
        urls.join(found, "host", "left").withColumn("__best", best)
        .withColumns({"rule": F.col("__best.rule"), "verdict": F.coalesce(F.col("__best.verdict"), F.lit(default))})
        .drop("__stack", "__best")
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)
