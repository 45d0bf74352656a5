"""Index build: records -> captures -> duplicate pick -> newest version -> documents -> chunks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import captures as C
from tidemark.operators import chunks as K
from tidemark.operators import documents as D
from tidemark.sources import derived as S
from tidemark.session import shared_table
from tidemark.sources.epochs import Store
from tidemark.sources.tables import table


@dataclass
class Inputs:
    pages: DataFrame
    sheet: DataFrame
    sites: DataFrame
    domains: DataFrame


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    pages = table(spark, sf_dir, "pages")
    sheet = S.site_sheet(pages)
    return Inputs(pages, sheet, S.site_list(sheet), S.domain_map(sheet))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of the pages, without bodies."""
    return S.captures_from_pages(table(spark, sf_dir, "pages"))


def latest_keys(spark: SparkSession, sf_dir: str, inp: Inputs | None = None) -> DataFrame:
    """Allowed domains only, duplicate pick per folder, newest version per page; without bodies."""
    inp = inp or inputs(spark, sf_dir)
    allowed = C.allowed_pages(S.captures_from_pages(inp.pages), inp.sites)
    return C.latest_captures(C.dedup_captures(allowed))


def latest_pages(spark: SparkSession, sf_dir: str, inp: Inputs | None = None) -> DataFrame:
    """The newest version of each page with its body."""
    inp = inp or inputs(spark, sf_dir)
    return S.with_bodies(latest_keys(spark, sf_dir, inp), S.response_records(inp.pages))


def page_documents(spark: SparkSession, sf_dir: str, inp: Inputs | None = None, text_fn=None) -> DataFrame:
    """Documents of the newest pages; those of the default conversion are written once and read by all that need them."""
    inp = inp or inputs(spark, sf_dir)
    build = lambda: D.pages_to_documents(latest_pages(spark, sf_dir, inp), inp.domains, text_fn=text_fn)
    return build() if text_fn else shared_table(spark, ("page-documents",), sf_dir, build)


def page_chunks(spark: SparkSession, sf_dir: str, inp: Inputs | None = None) -> DataFrame:
    """Cleaned, chunked, embedded page documents: the search corpus, written once and read by all searches."""
    return shared_table(spark, ("page-chunks",), sf_dir, lambda: K.embed_default(K.chunk_tokens(K.clean_documents(page_documents(spark, sf_dir, inp)))))


def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's markdown documents with index keys ``source/doc_id.md``."""
    d = table(spark, sf_dir, "documents", spread=True)
    return d.select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_path"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"),
        F.col("source").alias("domain"), "doc_id", "lang", "text",
    )


def build_index(spark: SparkSession, docs: DataFrame, store_path: str, embed_fn=None) -> DataFrame:
    """Batch indexing run: documents whose key isn't indexed -> clean -> chunk -> embed
    (default hashed counts, or ``embed_fn`` with adaptive batching; a document with a failed
    chunk is kept in the failed table and tried again by the next run) -> one more epoch of
    the store.  Returns the run summary (chunks, files indexed, skipped, already indexed)."""
    from tidemark.streaming import incremental as ST

    store = Store(spark, store_path)
    ST.merge_new_keys(spark, store)
    docs = docs.dropDuplicates(["file_path"])
    already = docs.count() - ST.not_indexed_yet(spark, store, docs).count()
    epoch = f"batch-{len(store.published()):06d}"
    again = ST.failed_documents(spark, store)
    if again is not None:
        docs = docs.unionByName(again.drop("error", "epoch").join(docs, "file_path", "left_anti"), allowMissingColumns=True)
    ST.index_epoch(spark, store, epoch, docs, embed_fn=embed_fn)
    ST.merge_new_keys(spark, store)
    new = store.read(ST.CHUNKS, [epoch])
    files = store.read(ST.NEW_KEYS, [epoch])
    chunks, indexed = new.count() if new is not None else 0, files.count() if files is not None else 0
    return spark.createDataFrame(
        [(chunks, indexed, docs.count() - already - indexed, already)],
        "chunks bigint, files_indexed bigint, files_skipped bigint, files_already_indexed bigint")
