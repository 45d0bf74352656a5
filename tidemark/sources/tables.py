"""Table sources: parquet tables, site lists, question sheets, lookup maps, markdown trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


# tables whose rows carry long texts: spread before per-row CPU work
TEXT_TABLES = {"documents", "pages", "conversations"}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan.

    ``spread=True`` for text tables feeding CPU-heavy per-row work: rows are
    spread over the cluster when the scan yields fewer partitions than cores."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread and name in TEXT_TABLES:
        from tidemark.session import spread_for_cpu

        df = spread_for_cpu(df)
    return df


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A user sheet (CSV with header, or parquet/json) with string columns."""
    reader = spark.read
    if fmt == "csv":
        return reader.option("header", "true").option("multiLine", "true").csv(path)
    return reader.format(fmt).load(path)


def read_json_map(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """A JSON object file ``{k: v, ...}`` as rows ``(key, value)`` (domain map, timestamp map)."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def write_lookup(rows: DataFrame, path: str) -> None:
    """A lookup table as JSON lines, one row each: written and read by many tasks."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_list(spark: SparkSession, path: str, col: str = "file_path") -> DataFrame:
    """A JSON list file ``["a", "b"]`` (indexed-file set) as one column."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "array<string>")).alias(col))


def markdown_tree(spark: SparkSession, root: str, force_domain: str | None = None) -> DataFrame:
    """Every ``*.md`` below ``root`` as ``(file_path, file_name, domain, rel_path, text)``.

    The domain is the first path segment under ``root`` unless ``force_domain`` is
    given, in which case keys become ``force_domain/rel_path``.
    """
    root = root.rstrip("/")
    df = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md")
        .text(root, wholetext=True)
        .select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("abs_path"))
    )
    rel = F.regexp_extract("abs_path", r"^.*?" + _escape(root.split(":", 1)[-1].lstrip("/")) + r"/(.*)$", 1)
    if force_domain:
        domain = F.lit(force_domain)
        key = F.concat(F.lit(force_domain + "/"), rel)
    else:
        domain = F.split_part(rel, F.lit("/"), F.lit(1))
        key = rel
    return df.select(
        key.alias("file_path"),
        F.regexp_extract(rel, r"([^/]*)$", 1).alias("file_name"),
        domain.alias("domain"),
        rel.alias("rel_path"),
        "text",
    )


def _escape(s: str) -> str:
    import re

    return re.escape(s)
