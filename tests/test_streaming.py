"""Incremental runs: a second run adds nothing; sentence packing rules."""

import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunks as K
from tidemark.operators.keys import merge_keys, not_stored, stored_keys
from tidemark.sources.epochs import Store
from tidemark.streaming import incremental as ST


def _to_docs(df):
    return df.select(F.col("key").alias("file_path"), F.col("key").alias("file_name"),
                     F.lit("d").alias("domain"), "text")


def test_index_stream_picks_up_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="stream-test-")
    src, table, ckpt = os.path.join(base, "in"), os.path.join(base, "chunks"), os.path.join(base, "ckpt")
    schema = "key string, text string"
    spark.createDataFrame([("a", "x\n" * 600), ("b", "y " * 10)], schema).coalesce(1).write.parquet(os.path.join(src, "p1"))
    st = spark.createDataFrame([], schema).schema
    store = ST.index_stream(spark, src + "/*", "*.parquet", table, ckpt, st, _to_docs)
    ids = lambda: sorted(r.chunk_id for r in store.read(ST.CHUNKS).collect())
    first = ids()
    assert first == ["a#0", "a#1", "b#0"]
    ST.index_stream(spark, src + "/*", "*.parquet", table, ckpt, st, _to_docs)   # nothing new
    assert ids() == first
    spark.createDataFrame([("c", "z " * 5), ("a", "again")], schema).coalesce(1).write.parquet(os.path.join(src, "p2"))
    ST.index_stream(spark, src + "/*", "*.parquet", table, ckpt, st, _to_docs)
    # 'a' is already indexed (key-based, as in the reference): only 'c' is added
    assert ids() == first + ["c#0"]
    assert sorted(r.key for r in stored_keys(spark, store).collect()) == ["a", "b", "c"]


def test_a_batch_that_dies_is_run_again_whole(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="stream-dies-")
    src, root, ckpt = os.path.join(base, "in"), os.path.join(base, "store"), os.path.join(base, "ckpt")
    schema = "key string, text string"
    spark.createDataFrame([(f"k{i}", "w " * (10 + i)) for i in range(9)], schema).repartition(3).write.parquet(os.path.join(src, "p"))
    st = spark.createDataFrame([], schema).schema
    write = Store.write

    def dies(self, table, epoch, rows, partition_by=None):
        """Some chunk files are there, then the batch ends before its keys are."""
        if table == ST.NEW_KEYS:
            raise RuntimeError("killed")
        write(self, table, epoch, rows.limit(4) if table == ST.CHUNKS else rows, partition_by)

    monkeypatch.setattr(Store, "write", dies)
    with pytest.raises(Exception, match="killed"):
        ST.index_stream(spark, src + "/*", "*.parquet", root, ckpt, st, _to_docs, files_per_batch=2)
    store = Store(spark, root)
    assert store.published() == [] and store.read(ST.CHUNKS) is None and os.path.isdir(os.path.join(root, ST.CHUNKS))
    monkeypatch.setattr(Store, "write", write)
    ST.index_stream(spark, src + "/*", "*.parquet", root, ckpt, st, _to_docs, files_per_batch=2)
    whole = K.chunk_tokens(K.clean_documents(_to_docs(spark.read.parquet(src + "/p"))))
    want = sorted((r.chunk_id, r.text) for r in whole.collect())
    assert sorted((r.chunk_id, r.text) for r in store.read(ST.CHUNKS).collect()) == want
    # a replay of a published epoch adds nothing
    done = store.published()
    ST.index_epoch(spark, store, next(e for e in done if e.startswith("stream-")), _to_docs(spark.read.parquet(src + "/p")))
    assert store.published() == done and store.read(ST.CHUNKS).count() == len(want)


def test_failed_documents_come_back(spark):
    base = tempfile.mkdtemp(prefix="stream-retry-")
    src, root, ckpt, flag = (os.path.join(base, x) for x in ("in", "store", "ckpt", "up"))
    schema = "key string, text string"
    spark.createDataFrame([("good", "fine " * 20), ("bad", "broken\n" * 700), ("empty", "")], schema).coalesce(1).write.parquet(os.path.join(src, "p"))
    st = spark.createDataFrame([], schema).schema

    def model(texts):
        if any("broken" in t for t in texts) and not os.path.exists(flag):
            raise RuntimeError("model is down")
        return [[float(len(t)), 1.0] for t in texts]

    store = ST.index_stream(spark, src + "/*", "*.parquet", root, ckpt, st, _to_docs, embed_fn=model)
    assert {r.file_path for r in store.read(ST.CHUNKS).collect()} == {"good"}
    left = ST.failed_documents(spark, store).collect()
    assert [(r.file_path, r.error) for r in left] == [("bad", "model is down")]
    ST.index_stream(spark, src + "/*", "*.parquet", root, ckpt, st, _to_docs, embed_fn=model)  # still down: kept, told once
    assert [r.file_path for r in ST.failed_documents(spark, store).collect()] == ["bad"]
    open(flag, "w").close()
    ST.index_stream(spark, src + "/*", "*.parquet", root, ckpt, st, _to_docs, embed_fn=model)  # no new file, the failed one is indexed
    assert sorted({r.file_path for r in store.read(ST.CHUNKS).collect()}) == ["bad", "good"]
    assert ST.failed_documents(spark, store).count() == 0
    assert sorted(r.key for r in stored_keys(spark, store).collect()) == ["bad", "good"]


def test_key_table_merges_and_joins_by_bucket(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="keys-") + "/s")
    assert stored_keys(spark, store) is None
    rows = lambda *ks: spark.createDataFrame(list(ks), "key string, kind string")
    merge_keys(spark, store, rows(("a", "page"), ("b", "page"), ("b", "page"), (None, "page")), buckets=4)
    merge_keys(spark, store, rows(("b", "document"), ("c", "document")), buckets=4)
    keys = stored_keys(spark, store, 4)
    assert {r.key: r.kinds for r in keys.collect()} == {"a": ["page"], "b": ["document", "page"], "c": ["document"]}
    docs = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "file_path string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rest = not_stored(docs, keys)
        plan = rest._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.n for r in rest.collect()) == [2, 3]
        # one exchange: that of the documents
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def pack_sentences(text: str, size: int = 512, overlap: int = 64) -> list[str]:
    """Greedy sentence packing: whole sentences up to ``size`` tokens per chunk;
    the next chunk starts with the previous chunk's trailing sentences that fit
    in ``overlap`` tokens; a sentence longer than ``size`` is cut into windows."""
    sents: list[list[str]] = []
    for s in re.split(r"(?<=[.!?])\s+|\n+", text or ""):
        toks = s.split()
        step = max(1, size - overlap)
        for i in range(0, len(toks), step if len(toks) > size else max(1, len(toks))):
            piece = toks[i:i + size]
            if piece:
                sents.append(piece)
            if i + size >= len(toks):
                break
    chunks: list[str] = []
    cur: list[list[str]] = []
    n = 0
    for s in sents:
        if cur and n + len(s) > size:
            chunks.append(" ".join(t for x in cur for t in x))
            tail: list[list[str]] = []
            m = 0
            for x in reversed(cur):
                if m + len(x) > overlap:
                    break
                tail.insert(0, x)
                m += len(x)
            # the kept tail gives way when the next sentence does not fit behind it
            while tail and m + len(s) > size:
                m -= len(tail.pop(0))
            cur, n = tail, m
        cur.append(s)
        n += len(s)
    if cur:
        chunks.append(" ".join(t for x in cur for t in x))
    return chunks


def test_pack_sentences_overlap_and_bounds():
    text = " ".join(f"s{i} a b c d." for i in range(30))
    chunks = pack_sentences(text, size=20, overlap=5)
    assert all(len(c.split()) <= 20 for c in chunks)
    # every chunk after the first starts with the last sentence of the previous one
    for prev, cur in zip(chunks, chunks[1:]):
        assert cur.split()[:5] == prev.split()[-5:]
    assert pack_sentences("   ") == []
    long_one = " ".join(str(i) for i in range(45))
    assert [len(c.split()) for c in pack_sentences(long_one, size=20, overlap=5)] == [20, 20, 15]


@pytest.mark.parametrize("size, overlap", [(20, 5), (7, 3), (512, 64)])
def test_chunk_sentences_equals_the_plain_packing(spark, sf, size, overlap):
    rng = random.Random(size)
    texts = [" ".join(rng.choice(["a", "b.", "c!", "d\n", "e?\n\n", "f \u2003g", "h.i", "."]) for _ in range(rng.choice([1, 5, 60, 400]))) for _ in range(80)]
    texts += [None, "", " \n ", "word " * 90, "no end", ". . .", "One. " * 3 + "two " * 30 + "three. four."]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    docs = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "file_path string, text string").repartition(3)
    got = {(r.file_path, r.pos): r.text for r in K.chunk_sentences(docs, size=size, overlap=overlap).collect()}
    want = {(f"k{i}", n): c for i, t in enumerate(texts) for n, c in enumerate(pack_sentences(t, size, overlap))}
    assert got == want


def test_batch_index_runs_are_incremental(spark):
    from tidemark.plans import indexing as I

    table = tempfile.mkdtemp(prefix="index-batch-") + "/chunks"
    docs = spark.createDataFrame([(f"k{i}", "d", "w\n" * (100 * i)) for i in range(6)],
                                 "file_path string, domain string, text string")
    r1 = I.build_index(spark, docs.where("file_path in ('k1', 'k2')"), table).first()
    r2 = I.build_index(spark, docs, table).first()
    r3 = I.build_index(spark, docs, table).first()
    assert (r1.files_indexed, r2.files_indexed, r2.files_already_indexed) == (2, 3, 2)
    assert r2.files_skipped == 1          # k0 has no text: never stored, retried each run
    assert (r3.chunks, r3.files_indexed, r3.files_already_indexed) == (0, 0, 5)


@pytest.mark.parametrize("folder", [False, True])
def test_index_stream_query_reads_a_table_of_one_file_or_of_many(spark, folder):
    from tidemark.plans.extra import q_index_stream

    sf = tempfile.mkdtemp(prefix="stream-query-")
    rows = spark.createDataFrame([(1, "one two", "s"), (2, "three", "t"), (3, None, "t")], "doc_id long, text string, source string")
    if folder:
        rows.repartition(2).write.parquet(f"{sf}/documents.parquet")
    else:
        rows.toPandas().to_parquet(f"{sf}/documents.parquet")
    assert sorted(r.chunk_id for r in q_index_stream(spark, sf).collect()) == ["s/1.md#0", "t/2.md#0"]
