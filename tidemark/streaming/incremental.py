"""Incremental indexing and ingest with Structured Streaming.

Both jobs run as ``trigger(availableNow=True)``: every run picks up only files
that arrived since the last run (the checkpoint remembers which), processes
them in bounded micro-batches and stops.  What a micro-batch writes is an epoch of a
:class:`tidemark.sources.epochs.Store`: its chunks, its new keys and its failed documents
count together from the moment its manifest entry is there.  A batch that dies before
is run again as the same epoch and replaces its files; one that dies after is not run
twice.  Failed documents are kept whole and are tried again at the start of the next run.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import chunks as K
from tidemark.operators.keys import BUCKETS, merge_keys, not_stored, stored_keys
from tidemark.session import materialise
from tidemark.sources import archives as A
from tidemark.sources.epochs import Store

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: Tables of an index store; ``keys`` is the merged key table.
CHUNKS, NEW_KEYS, FAILED = "chunks", "new_keys", "failed"


def _run_name(checkpoint: str) -> str:
    """Part of the epoch names of one checkpoint, whose epoch numbers start from 0."""
    return hashlib.md5(checkpoint.encode()).hexdigest()[:8]


def unmerged_keys(store: Store) -> DataFrame | None:
    """(key, kind) of the published epochs that the key table doesn't hold yet."""
    done = set(store.marked("merged"))
    return store.read(NEW_KEYS, [e for e in store.published() if e not in done])


def not_indexed_yet(spark: SparkSession, store: Store, docs: DataFrame, key_col: str = "file_path") -> DataFrame:
    """Documents whose key is in no published epoch: an anti join with the key table, and one with the keys since its last merge."""
    rest = not_stored(docs, stored_keys(spark, store), key_col)
    since = unmerged_keys(store)
    return rest if since is None else rest.join(since.select(F.col("key").alias(key_col)), key_col, "left_anti")


def merge_new_keys(spark: SparkSession, store: Store, buckets: int = BUCKETS) -> None:
    """Unite the keys of all epochs since the last merge with the key table; a merge that dies is repeated by the next run."""
    epochs = [e for e in store.published() if e not in set(store.marked("merged"))]
    new = store.read(NEW_KEYS, epochs)
    if new is not None:
        merge_keys(spark, store, new.select("key", "kind"), buckets)
    for e in epochs:
        store.mark("merged", e)


def index_epoch(spark: SparkSession, store: Store, epoch: str, docs: DataFrame, embed=K.embed_default, embed_fn=None, key_col: str = "file_path") -> None:
    """Clean, chunk and embed the documents that aren't indexed yet, as one epoch.

    ``embed(chunks)`` adds the vectors; with ``embed_fn`` (texts -> vectors) a document with a
    failed chunk gets none of its chunks stored and goes whole into the failed table, with
    its error.  Documents without any chunk get no key, so they are looked at again."""
    if epoch in store.published():
        return
    todo = materialise(not_indexed_yet(spark, store, docs.dropDuplicates([key_col]), key_col), "todo")
    chunks = K.chunk_tokens(K.clean_documents(todo))
    failed = None
    if embed_fn is None:
        chunks = embed(chunks)
    else:
        vectors = materialise(K.embed_with(chunks, embed_fn), "vectors")
        failed = vectors.filter("error is not null").groupBy(key_col).agg(F.min("error").alias("error"))
        chunks = K.drop_failed_documents(chunks, vectors)
    kind = F.col("kind") if "kind" in todo.columns else F.lit("document")
    store.write(CHUNKS, epoch, chunks, ["domain"])
    indexed = spark.read.schema(chunks.schema).parquet(store.folder(CHUNKS, epoch)).select(key_col).distinct()
    store.write(NEW_KEYS, epoch, todo.join(indexed, key_col, "left_semi").select(F.col(key_col).alias("key"), kind.alias("kind")))
    if failed is not None:
        store.write(FAILED, epoch, todo.join(failed, key_col))
    store.publish(epoch)


def failed_documents(spark: SparkSession, store: Store, key_col: str = "file_path") -> DataFrame | None:
    """Documents of the failed table that no later epoch has indexed, each once, with their last error; None if nothing ever failed."""
    failed = store.read(FAILED)
    if failed is None:
        return None
    last = failed.groupBy(key_col).agg(F.max_by(F.struct(*[c for c in failed.columns if c != key_col]), "epoch").alias("__row"))
    return not_indexed_yet(spark, store, last.select(key_col, "__row.*"), key_col)


def retry_failed(spark: SparkSession, store: Store, run: str, embed=K.embed_default, embed_fn=None, key_col: str = "file_path") -> None:
    """Index the failed documents again, as an epoch of their own; those that fail again stay in the failed table."""
    again = failed_documents(spark, store, key_col)
    if again is not None and again.limit(1).count():
        n = sum(e.startswith("retry-") for e in store.published())
        index_epoch(spark, store, f"retry-{n:06d}-{run}", again.drop("error", "epoch"), embed, embed_fn, key_col)


def index_stream(spark: SparkSession, docs_dir: str, glob: str, store_path: str, checkpoint: str,
                 schema: StructType, to_documents, files_per_batch: int = 8, embed=K.embed_default, embed_fn=None) -> Store:
    """New document files -> clean -> chunk -> embed -> the chunks of a store.

    ``to_documents(df)`` maps the raw file rows to ``(file_path, file_name,
    domain, text, ...)``; ``embed`` and ``embed_fn`` as in :func:`index_epoch`.
    Documents whose key is indexed already are skipped, of rows with one key in a batch
    one is taken, and documents that failed in an earlier run are tried again.
    """
    store = Store(spark, store_path)
    merge_new_keys(spark, store)
    retry_failed(spark, store, _run_name(checkpoint), embed, embed_fn)
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", files_per_batch).parquet(docs_dir))

    def batch(df: DataFrame, epoch_id: int) -> None:
        index_epoch(spark, store, f"stream-{_run_name(checkpoint)}-{epoch_id:09d}", to_documents(df), embed, embed_fn)

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    merge_new_keys(spark, store)
    return store


def ingest_stream(spark: SparkSession, archive_dir: str, store_path: str, checkpoint: str,
                  files_per_batch: int = 16) -> Store:
    """New archive files -> the records of a store.  The stream carries only file names
    (contents are opened by path in the parse tasks); a table of done archives, one row
    each, tells which whole paths were read."""
    store = Store(spark, store_path)
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", A.ARCHIVE_GLOB)
              .option("maxFilesPerTrigger", files_per_batch).load(archive_dir).select("path"))

    def batch(df: DataFrame, epoch_id: int) -> None:
        epoch = f"stream-{_run_name(checkpoint)}-{epoch_id:09d}"
        if epoch in store.published():
            return
        # by whole path: two folders may hold archives of one name
        files = df.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name")).distinct()
        done = store.read("done")
        if done is not None:
            files = files.join(done.select("path"), "path", "left_anti")
        n = max(1, files.count())
        store.write("records", epoch, files.repartitionByRange(n, "path").mapInPandas(A._parse_partition, A.RECORD_SCHEMA))
        store.write("done", epoch, files.select("path"))
        store.publish(epoch)

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return store
