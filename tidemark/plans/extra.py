"""Registered queries without an SQL oracle (rows-only checks).

These run Python stages (archive codec, HTML parser, user model hooks),
approximate search, or streaming jobs; pytest checks them against small
hand-made fixtures and brute-force answers.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import charsets as CS
from tidemark.operators import ann as ANN
from tidemark.operators import chunks as K
from tidemark.operators import documents as D
from tidemark.operators import hooks as H
from tidemark.operators import markdown as M
from tidemark.operators import records as Rec
from tidemark.operators import search as R
from tidemark.operators.keys import stored_keys
from tidemark.plans import catalog as Q
from tidemark.plans import indexing as I
from tidemark.session import scratch_path
from tidemark.sources import archives as A
from tidemark.sources import derived as S
from tidemark.sources.epochs import Store
from tidemark.sources.tables import read_lookup, table, write_lookup
from tidemark.streaming import incremental as ST



def _written_archives(spark: SparkSession, sf: str) -> str:
    """Archive files of all crawls of the pages, written by a Spark job into a
    fresh folder under the shared checkpoint folder."""
    out = scratch_path(spark, "archives")
    recs = S.warc_records(table(spark, sf, "pages"))
    n_arch = recs.select("archive").distinct().count()
    A.write_archives(recs, out, max(1, n_arch)).write.format("noop").mode("overwrite").save()
    return out


#: A copy of an archive that ends in the middle of a record.
DAMAGED = "DAMAGED-00000.warc.gz"


def _with_a_damaged_archive(spark: SparkSession, sf: str) -> str:
    """The archives of the pages and one more: three fifths of the bytes of the first of them by name."""
    out = _written_archives(spark, sf)
    first = A.archive_files(spark, out).orderBy("name").first()["path"]

    def cut(batches):
        for b in batches:
            for content in b["content"]:
                with A._output_stream(f"{out}/{DAMAGED}") as f:
                    f.write(bytes(content[: len(content) * 3 // 5]))
            yield b[["length"]]

    spark.read.format("binaryFile").load(first).select("content", "length").mapInPandas(cut, "length long").write.format("noop").mode("overwrite").save()
    return out


def q_archive_files(spark, sf):
    return A.archive_files(spark, _written_archives(spark, sf))


def q_records(spark, sf):
    recs = A.read_records(spark, _written_archives(spark, sf))
    return recs.select("archive", "warc_type", "target_uri", "http_status", "http_reason", "http_command", "media_type",
                       F.octet_length("body").cast("bigint").alias("body_bytes"), "error")


def q_archive_captures(spark, sf):
    """Archives -> records -> HTML responses -> captures, with times from the archive names."""
    caps = S.captures_from_archives(A.read_records(spark, _written_archives(spark, sf)), Rec.HTML_SELECTION)
    return caps.select("archive", "domain", "rel_path", "capture_ts", "size", "content_encoding")


def q_records_filtered(spark, sf):
    """Filtered dump: response records of HTML pages, not 404, written as a table."""
    recs = A.read_records(spark, _written_archives(spark, sf))
    kept = Rec.header_filter(recs, Q.HEADER_FILTERS)
    out = scratch_path(spark, "filtered")
    kept.write.parquet(out)
    return spark.read.parquet(out).select("archive", "warc_type", "target_uri", "http_status")


def q_record_errors(spark, sf):
    """Dead letters of all archives, one of them damaged, and how many of its records were read before the damage."""
    recs = A.read_records(spark, _with_a_damaged_archive(spark, sf))
    whole = recs.filter("error is null").groupBy(F.col("archive").alias("a")).agg((F.count(F.lit(1)) > 0).alias("read_before"))
    return Rec.record_errors(recs).join(whole, F.col("archive") == F.col("a")).select("archive", (F.length("error") > 0).alias("told"), "read_before")


def q_pages_markdown(spark, sf):
    latest = I.latest_pages(spark, sf)
    return M.pages_markdown(latest).select("domain", "rel_path", "status", "n_chars")


def q_markdown_documents(spark, sf):
    inp = I.inputs(spark, sf)
    docs = M.markdown_documents(I.latest_pages(spark, sf, inp), inp.domains)
    return docs.select("file_path", "title", "url", "url_preview", "retrieval_date", F.length("text").alias("chars"))


def q_index_build(spark, sf):
    """Two batch indexing runs: English documents first, then everything (the
    second run indexes only the rest); returns both run summaries."""
    table_path = scratch_path(spark, "index-batch") + "/chunks"
    docs = I.corpus_documents(spark, sf)
    first = I.build_index(spark, docs.where(F.col("lang") == "en"), table_path).withColumn("run", F.lit(1))
    second = I.build_index(spark, docs, table_path).withColumn("run", F.lit(2))
    return first.unionByName(second)


def _limited_model(max_chars: int = 6000):
    """Stand-in for a remote model with a request size limit (hashed counts of
    the first 64 term buckets); raises a size error for oversized batches."""
    import hashlib

    def fn(texts):
        if sum(len(t) for t in texts) > max_chars:
            raise ValueError("413 request too large: input length exceeds limit")
        out = []
        for t in texts:
            v = [0.0] * 64
            for w in t.lower().split():
                v[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64] += 1.0
            out.append(v)
        return out

    return fn


def q_adaptive_embed(spark, sf):
    chunks = K.chunk_tokens(K.clean_documents(I.corpus_documents(spark, sf)))
    vecs = K.embed_with(chunks, _limited_model(), batch_rows=64)
    return K.drop_failed_documents(chunks, vecs).select("chunk_id", "file_path", F.size("embedding").cast("bigint").alias("dim"))


def q_lsh_recall(spark, sf):
    e = table(spark, sf, "embeddings")
    q = Q.every_hundredth(e)
    exact = R.knn_exact(q, e, Q.SELF_SEARCH_K, id_col="vec_id")
    approx = R.knn_lsh(q, e, Q.SELF_SEARCH_K, dim=64, id_col="vec_id")
    return R.recall_vs_exact(approx, exact, id_col="vec_id")


#: Hits of each query of the index search, as its recall is stated.
INDEX_K = 10


def q_knn_ivf(spark, sf):
    e = table(spark, sf, "embeddings")
    hits = ANN.knn_ivf(Q.every_hundredth(e), ANN.build(e), INDEX_K)
    return hits.select("qid", F.col("rank").cast("bigint").alias("rank"), "score", F.col("id").alias("vec_id"), "scanned", "scored")


def q_ivf_recall(spark, sf):
    """Recall of the index search and the shares of the rows it reads and scores, for each query."""
    e = table(spark, sf, "embeddings")
    q, index = Q.every_hundredth(e), ANN.build(e)
    exact = R.knn_exact(q, e, INDEX_K, id_col="vec_id").withColumnRenamed("vec_id", "id")
    return ANN.recall_report(ANN.knn_ivf(q, index, INDEX_K), exact, index.rows)


def q_lookup_export(spark, sf):
    """Domain map as JSON lines, a row for each site."""
    return I.inputs(spark, sf).domains.select("domain", F.to_json(F.struct("domain", "base_url")).alias("json"))


def q_index_stream(spark, sf):
    """Two incremental runs over the files of the documents table: the second finds nothing new."""
    base = scratch_path(spark, "index")
    table_path, ckpt = f"{base}/chunks", f"{base}/_checkpoint"
    schema = table(spark, sf, "documents").schema

    def to_docs(df):
        return df.select(
            F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_path"),
            F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"),
            F.col("source").alias("domain"), "text")

    # the table is one file or a folder of files: a stream takes both by a pattern
    files = f"{sf.rstrip('/')}/{{documents.parquet}}"
    for _ in range(2):
        store = ST.index_stream(spark, files, "*", table_path, ckpt, schema, to_docs)
    return store.read(ST.CHUNKS).select("chunk_id", "file_path", "pos", "domain")


def q_indexed_keys(spark, sf):
    """The key table after two runs: pages and documents, whose keys are merged into one set."""
    store = Store(spark, scratch_path(spark, "index-keys"))
    pages = I.page_documents(spark, sf).select("file_path", "domain", "text", F.lit("page").alias("kind"))
    ST.index_epoch(spark, store, "run-0", pages)
    ST.merge_new_keys(spark, store)
    docs = I.corpus_documents(spark, sf).select("file_path", "domain", "text", F.lit("document").alias("kind"))
    ST.index_epoch(spark, store, "run-1", docs)
    ST.merge_new_keys(spark, store)
    return stored_keys(spark, store).select("key", F.array_join("kinds", ",").alias("kinds"))


def q_ingest_stream(spark, sf):
    arch = _written_archives(spark, sf)
    base = scratch_path(spark, "ingest")
    table_path, ckpt = f"{base}/records", f"{base}/_checkpoint"
    for _ in range(2):
        store = ST.ingest_stream(spark, arch, table_path, ckpt)
    return store.read("records").select("archive", "warc_type", "target_uri")


def q_chunk_sentences(spark, sf):
    docs = K.clean_documents(I.corpus_documents(spark, sf))
    return K.chunk_sentences(docs).select("chunk_id", "file_path", "pos", F.size(F.split("text", " ")).alias("n_tokens"), "text")


def q_capture_sink(spark, sf):
    out = scratch_path(spark, "captures")
    D.write_captures(I.latest_pages(spark, sf), out)
    return spark.read.parquet(out).select("domain", "rel_path", "archive", "size")


def q_eval_export(spark, sf):
    from tidemark.operators import evaluate as E

    hits, qs, rel = Q._hits(spark, sf)
    ev = E.eval_questions(hits, qs, rel, Q._scenarios(spark))
    out = scratch_path(spark, "evaluation")
    E.eval_export(ev, E.scenario_metrics(ev), E.accuracy_at_k(ev), out, {"top_k": Q.EVAL_K, "scenarios": [s[0] for s in R.SCENARIOS]})
    return spark.read.json(f"{out}/metrics").select("scenario", "successful", "failed", "accuracy", "recall")


def q_ingest_summary(spark, sf):
    return Rec.ingest_summary(A.read_records(spark, _with_a_damaged_archive(spark, sf)))


def q_markdown_tree(spark, sf):
    """Markdown sink + scan round trip: documents written as ``domain/path.md``
    files, then read back as a tree (domain = first path segment)."""
    from tidemark.sources.tables import markdown_tree

    root = scratch_path(spark, "markdown")
    D.write_markdown_tree(I.page_documents(spark, sf), root).write.format("noop").mode("overwrite").save()
    return markdown_tree(spark, root).select("file_path", "domain", F.length("text").cast("bigint").alias("chars"))


def q_lookup_import(spark, sf):
    """Domain map written as a lookup table and read back."""
    out = scratch_path(spark, "lookup")
    write_lookup(I.inputs(spark, sf).domains.select("domain", "base_url"), out)
    return read_lookup(spark, out, "domain string, base_url string")


def q_timestamp_map(spark, sf):
    """Page path -> capture time, written as a lookup table and read back."""
    out = scratch_path(spark, "timestamps")
    latest = I.latest_keys(spark, sf)
    write_lookup(latest.select(
        F.concat("domain", F.lit("/"), "rel_path").alias("page"), F.date_format("capture_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("retrieved")), out)
    return read_lookup(spark, out, "page string, retrieved string")


def q_imported_times(spark, sf):
    """Documents of the newest pages with the times of an imported map: two thirds of the pages are in it, two capture times each
    (the later one a year after the folder's stamp), and a fifth of the folders carry no stamp."""
    latest = I.latest_keys(spark, sf)
    number = F.conv(F.substring(F.md5(F.concat("domain", F.lit("/"), "rel_path")), 1, 6), 16, 10).cast("long")
    rows = latest.select("domain", "rel_path", "archive", "capture_ts", number.alias("n"))
    show = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    both = F.array(F.col("capture_ts") - F.expr("interval 1 hour"), F.col("capture_ts") + F.expr("interval 365 days"))
    times = rows.filter("n % 3 <> 0").select(F.concat("domain", F.lit("/"), "rel_path").alias("page"), F.explode(both).alias("t"))
    out = scratch_path(spark, "imported-times")
    write_lookup(times.select("page", show("t").alias("retrieved")), out)
    docs = rows.select(
        F.concat("domain", F.lit("/"), D.markdown_rel_path("rel_path")).alias("file_path"), "rel_path",
        F.when(F.col("n") % 5 == 0, F.concat(F.lit("crawl_"), "domain")).otherwise(F.concat("archive", F.lit("_"), "domain")).alias("folder"))
    found = D.with_retrieval_time(docs, read_lookup(spark, out, "page string, retrieved string"))
    return found.select("file_path", "rel_path", "folder", show("retrieval_date").alias("retrieval_date"), "time_source")


def _rewrite(texts: list[str]) -> list[str]:
    """Stand-in for a user's expansion model: some questions fail, some get nothing, the others are said twice."""
    if any(len(t) % 7 == 0 for t in texts):
        raise ValueError("no answer")
    return ["" if len(t) % 5 == 0 else t + " " + t.lower() for t in texts]


def q_expanded_by_model(spark, sf):
    """Two runs of an expansion function over the benchmark's questions: good results are sent once, the others again."""
    store = Store(spark, scratch_path(spark, "expansions"))
    questions = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    for _ in range(2):
        results = H.expand_questions(spark, store, questions, _rewrite)
    return H.with_expansions(questions, results).select("qid", "search_text", "status", F.col("sent").cast("bigint").alias("sent"))


def _asked_hits(spark, sf):
    """The plain search hits with their questions and texts."""
    hits, qs, _ = Q._hits(spark, sf)
    plain = hits.where(F.col("scenario") == R.SCENARIOS[0][0]).select("qid", "rank", "chunk_id", "text")
    return plain.join(qs.select("qid", "question"), "qid")


def q_reranked_bm25(spark, sf):
    inp = I.inputs(spark, sf)
    ranked = H.rerank_bm25(_asked_hits(spark, sf), H.term_statistics(I.page_chunks(spark, sf, inp)), ["qid"])
    return ranked.select("qid", "chunk_id", "rerank_score", F.col("retrieval_rank").cast("bigint").alias("retrieval_rank"))


def _brevity(question: str, texts: list[str]) -> list[float]:
    """Stand-in for a user's scorer: short texts that hold the question's first word."""
    first = question.split()[0].lower() if question.split() else ""
    return [(1.0 if first in t.lower() else 0.0) - len(t) / 1e6 for t in texts]


def q_reranked_by_scorer(spark, sf):
    ranked = H.rerank_by(_asked_hits(spark, sf), _brevity, ["qid"])
    return ranked.select("qid", "chunk_id", F.round("rerank_score", 6).alias("rerank_score"), F.col("rank").cast("bigint").alias("rank"),
                         F.col("retrieval_rank").cast("bigint").alias("retrieval_rank"))


def q_decoded_pages(spark, sf):
    """Pages re-encoded by a recipe (page_id modulo 6) and decoded again by what their bytes and headers tell."""
    latin = F.regexp_replace("html", "[^\\x{00}-\\x{FF}]", "?")
    tagged = F.concat(F.lit('<meta charset="latin1">'), latin)
    way = F.col("page_id") % 6
    body = (
        F.when(way == 0, F.encode("html", "UTF-8")).when(way == 1, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("html", "UTF-8")))
        .when(way == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode("html", "UTF-16LE"))).when(way == 3, F.encode(latin, "ISO-8859-1"))
        .when(way == 4, F.encode(tagged, "ISO-8859-1")).otherwise(F.encode(latin, "ISO-8859-1")))
    header = F.when(way == 3, "text/html; charset=ISO-8859-1").when(way == 0, "text/html; charset=x-unknown")
    pages = table(spark, sf, "pages").select("page_id", body.alias("body"), header.alias("content_type"))
    named = pages.withColumn("charset", CS.charset(F.col("body"), F.col("content_type")))
    return named.select("page_id", "charset", F.md5(CS.decoded(F.col("body"), F.col("charset"))).alias("text_md5"))


EXTRA_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "knn_lsh": Q.q_knn_lsh,
    "lsh_recall": q_lsh_recall,
    "knn_ivf": q_knn_ivf,
    "ivf_recall": q_ivf_recall,
    "archive_files": q_archive_files,
    "records": q_records,
    "archive_captures": q_archive_captures,
    "records_filtered": q_records_filtered,
    "record_errors": q_record_errors,
    "pages_markdown": q_pages_markdown,
    "markdown_documents": q_markdown_documents,
    "adaptive_embed": q_adaptive_embed,
    "lookup_export": q_lookup_export,
    "index_stream": q_index_stream,
    "indexed_keys": q_indexed_keys,
    "index_build": q_index_build,
    "ingest_stream": q_ingest_stream,
    "chunk_sentences": q_chunk_sentences,
    "capture_sink": q_capture_sink,
    "eval_export": q_eval_export,
    "ingest_summary": q_ingest_summary,
    "markdown_tree": q_markdown_tree,
    "lookup_import": q_lookup_import,
    "timestamp_map": q_timestamp_map,
    "imported_times": q_imported_times,
    "expanded_by_model": q_expanded_by_model,
    "reranked_bm25": q_reranked_bm25,
    "reranked_by_scorer": q_reranked_by_scorer,
    "decoded_pages": q_decoded_pages,
}
