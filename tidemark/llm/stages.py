"""Stages of the corpus pipeline: each applies one operator and lets its decision take effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import among, bits_of, stored, table, text_key


def _beside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns an operator would replace (in any case) under names of their own, and the way back to its columns."""
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in names}
    return docs.withColumnsRenamed(own), lambda out: out.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the ranking model scores below its threshold.

    A null text counts as an empty one and is judged like it; equal texts get equal
    scores, so copies stay or go together; repeated rows stay repeated.  The document's
    own columns come back unchanged, also those named like the operator's.  A very long
    text is scored whole; no documents give none."""
    from .quality import score_quality

    aside, own = _beside(docs, "held_out", "score", "predicted")
    return own(score_quality(aside, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).filter("predicted = 1"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of similar texts: that with the smallest doc_id.

    Rows are told apart by a number of their own, so doc_id may be null or repeated: rows
    without doc_id come last in their group, and rows of one doc_id with different texts
    are different documents.  Ties go by text and then by the other columns.  Null
    and empty texts are in no group and stay.  Very long texts are compared whole; no
    documents give none."""
    from .jaccard_join import near_duplicates

    told = docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("__at"))
    # written once, so that the number of a row never changes
    told = stored(told.withColumn("__order", F.xxhash64(*[F.to_json(F.struct(F.col(f"row.`{c}`"))) for c in docs.columns if c != "text"])), "told")
    text, doc_id = F.col("row.text"), F.col("row.doc_id")
    groups = near_duplicates(told.select(F.col("__at").alias("doc_id"), text.alias("text")))
    order = F.struct(doc_id.isNull(), doc_id, text_key(text), F.col("__order"), F.col("__at"))
    ranked = told.select("__at", order.alias("order")).join(groups.select(F.col("doc_id").alias("__at"), "component_id"), "__at")
    first = ranked.groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.__at").alias("__at"))
    # the numbers of the rows that stay go to the rows as bits, so the texts are not shuffled
    return among(told, F.col("__at"), stored(bits_of(first), "first-rows")).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents.

    Null and empty texts hold no words and stay; repeated rows stay or go together; the
    document's own columns come back unchanged, also those named like the operator's.
    Very long texts are judged whole; no documents give none."""
    from .decontaminate import contamination

    aside, own = _beside(docs, "n_words", "n_hit", "n_items", "items", "contaminated")
    return own(contamination(aside, table(spark, sf_dir, "benchmark")).filter(~F.col("contaminated")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark and count the characters anew; every document stays.

    Null texts stay null with a null count, empty ones empty; all other columns come
    back unchanged; repeated rows stay repeated; a very long text is scanned whole; no
    documents give none."""
    from .secret_scan import redact

    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into training sequences: one row per piece, with its ids.

    A null or empty text is the end id alone; rows that repeat are packed each for
    itself; other columns are left out; a very long text fills as many sequences as it
    needs; no documents give no rows."""
    from .packing import pack

    return pack(docs)
