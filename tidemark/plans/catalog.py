"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the driver tables (or data Spark derives from them) in full.
Output columns carry the same names as the oracle SQL in ``tidemark.plans.oracle``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.operators import captures as C
from tidemark.operators import chunks as K
from tidemark.operators import documents as D
from tidemark.operators import evaluate as E
from tidemark.operators import records as Rec
from tidemark.operators import search as R
from tidemark.plans import indexing as I
from tidemark.sources import derived as S
from tidemark.session import scratch_path, shared_table
from tidemark.sources.epochs import Store
from tidemark.sources.tables import table

EVAL_K = 100
SELF_SEARCH_K = 10
HEADER_FILTERS = ["warc-type:response", "content-type:application/http", "http:content-type:text/html", "!http:error:404"]
KEY_FILTERS = [
    "http:status:not found", "http:error:404", "!http:error:404", "http:version:1.1", "http:command:get", "http:path:/en/",
    "http:content_type:pdf", "http:charset:utf-8", "warc-type:request", "!http:status:ok",
]
DENY_PATTERN = r"spam|pills"
STORED_LANG = "en"  # documents of an earlier run already in the chunk store


# ---------------------------------------------------------------- URL / capture queries
def q_site_list(spark, sf):
    return I.inputs(spark, sf).sites


def q_domain_map(spark, sf):
    return I.inputs(spark, sf).domains


def q_base_site(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", "url", U.base_site("url").alias("base_site"), U.base_url("url").alias("base_url"))


def q_base_url(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", U.base_url("url").alias("base_url"))


def q_suffix_repair(spark, sf):
    recs = S.response_records(table(spark, sf, "pages"))
    return C.with_archive_path(recs).select("archive", "seq", "rel_path", "suffix_known")


def q_numbered_paths(spark, sf):
    return I.captures(spark, sf).select("archive", "seq", "domain", "rel_path")


def q_url_matches(spark, sf):
    """Every pair of relevant URLs of one question (equi-join on the question):
    do they match under URL normalization?"""
    bench, pages = table(spark, sf, "benchmark"), table(spark, sf, "pages")
    _, rel = E.questions_long(S.question_sheet(bench, pages))
    a = rel.select("qid", F.col("pos").alias("pos_a"), U.normalize_url("url").alias("na"))
    b = rel.select("qid", F.col("pos").alias("pos_b"), U.normalize_url("url").alias("nb"))
    return a.join(b, "qid").select("qid", "pos_a", "pos_b", U.urls_match(F.col("na"), F.col("nb")).alias("matches"))


def q_normalized_urls(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", U.normalize_url("url").alias("norm_url"))


def q_archive_path(spark, sf):
    recs = S.response_records(table(spark, sf, "pages"))
    return C.with_archive_path(recs).select("archive", "seq", "domain", "rel_path", "suffix_known")


def q_captures(spark, sf):
    return I.captures(spark, sf).select("archive", "seq", "domain", "rel_path", "capture_ts", "size",
                                        "content_encoding", "http_status")


def q_capture_key(spark, sf):
    return I.captures(spark, sf).select("archive", "capture_ts").distinct()


def q_folder_key(spark, sf):
    """Capture folders ``{archive}_{domain}`` back to time and domain."""
    folders = I.captures(spark, sf).select(F.concat("archive", F.lit("_"), "domain").alias("folder")).distinct()
    ts, domain = C.folder_key("folder")
    return folders.select("folder", ts.alias("capture_ts"), domain.alias("domain"))


def q_page_url_variants(spark, sf):
    """URLs of the newest HTML pages below a base path, and of a file at the root of its tree."""
    inp = I.inputs(spark, sf)
    pages = I.latest_keys(spark, sf, inp).where(F.col("rel_path").rlike(D.HTML_FILE_PATTERN))
    pages = pages.join(inp.domains, "domain", "left").withColumn("page", D.page_path_from_md(D.markdown_rel_path("rel_path")))
    below = D.page_urls(F.col("page"), F.col("base_url"), "snapshots/")
    root = D.page_urls(F.lit(None).cast("string"), F.col("base_url"))
    both = F.array(
        F.struct(F.lit("base path").alias("variant"), below[0].alias("url"), below[1].alias("url_preview")),
        F.struct(F.lit("root file").alias("variant"), root[0].alias("url"), root[1].alias("url_preview")))
    return pages.select("domain", "rel_path", F.explode(both).alias("v")).select("domain", "rel_path", "v.*")


def q_dropped_lines_total(spark, sf):
    """Lines over the limit, over all documents."""
    d = table(spark, sf, "documents", spread=True)
    return d.agg(F.sum(T.count_long_lines("text")).cast("bigint").alias("dropped_lines"), F.count(F.lit(1)).alias("documents"))


def q_normalized_name(spark, sf):
    return I.captures(spark, sf).select("archive", "seq", "rel_path", C.normalized_name("rel_path").alias("norm_name"))


def q_fingerprint(spark, sf):
    c = I.captures(spark, sf)
    return c.select("archive", "seq", "fingerprint")


def _allowed_captures(spark, sf):
    inp = I.inputs(spark, sf)
    return C.allowed_pages(S.captures_from_pages(inp.pages), inp.sites)


def q_dedup_captures(spark, sf):
    return C.dedup_captures(_allowed_captures(spark, sf)).select("archive", "seq", "domain", "rel_path", "size", "capture_ts")


def q_latest_captures(spark, sf):
    return I.latest_keys(spark, sf).select("domain", "rel_path", "archive", "seq", "capture_ts", "size")


def q_allowed_pages(spark, sf):
    return _allowed_captures(spark, sf).select("archive", "seq", "domain", "rel_path")


def q_denied_pages(spark, sf):
    pages = table(spark, sf, "pages")
    deny = pages.where(F.col("url").rlike(DENY_PATTERN)).select(U.base_site("url").alias("domain")).distinct()
    return C.denied_pages(I.captures(spark, sf), deny).select("archive", "seq", "domain", "rel_path")


def q_domain_summary(spark, sf):
    return C.domain_summary(I.latest_keys(spark, sf))


def q_dup_counts(spark, sf):
    return C.dup_counts(_allowed_captures(spark, sf))


def q_keyword_excluded(spark, sf):
    c = I.captures(spark, sf)
    return c.select("archive", "seq", "rel_path",
                    D.keyword_excluded(D.file_name("rel_path"), D.HTML_EXCLUDE_FILE_KEYWORDS).alias("excluded"))


# ---------------------------------------------------------------- documents
def q_page_titles(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    return p.select("page_id", T.html_title("html").alias("title"))


def q_page_text(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    return p.select("page_id", T.html_text("html").alias("text"))


def q_html_documents(spark, sf):
    return I.page_documents(spark, sf).select("file_path", "file_name", "domain", "title", "source", "url",
                                              "url_preview", "retrieval_date", "kind", "text")


def q_documents_union(spark, sf):
    html = I.page_documents(spark, sf)
    pdf = D.pdf_to_documents(_pdf_documents(spark, sf))
    return D.all_documents(html, pdf).select("file_path", "kind", "title", "text")


def q_page_urls(spark, sf):
    return I.page_documents(spark, sf).select("file_path", "url", "url_preview")


def q_retrieval_dates(spark, sf):
    return I.page_documents(spark, sf).select("file_path", "retrieval_date")


def q_conversion_summary(spark, sf):
    inp = I.inputs(spark, sf)
    conv = D.html_documents(I.latest_pages(spark, sf, inp), inp.domains)
    return D.conversion_summary(conv)


def _pdf_pages(spark, sf):
    c = table(spark, sf, "conversations", spread=True)
    return c.select(F.col("conv_id").alias("file"),
                    F.concat(F.lit("doc"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("file_name"),
                    F.col("turn").alias("page_no"), F.when(F.col("conv_id") % 9 == 2, F.lit(" \n")).otherwise(F.col("text")).alias("text"))


def _pdf_documents(spark, sf):
    """PDFs assembled from their pages; some files have blank pages only, and some no page at all."""
    pages = _pdf_pages(spark, sf)
    return D.pdf_documents(pages.where(F.col("file") % 11 != 7), files=pages.select("file", "file_name"))


def q_pdf_documents(spark, sf):
    return _pdf_documents(spark, sf)


def q_pdf_summary(spark, sf):
    return D.pdf_summary(_pdf_documents(spark, sf))


def q_long_lines_dropped(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    kept = T.drop_long_lines("text")
    return d.select("doc_id", T.count_long_lines("text").cast("bigint").alias("dropped_lines"),
                    F.length(kept).cast("bigint").alias("chars_kept"))


def q_garbage_cleaned(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", T.clean_garbage(T.drop_long_lines("text")).alias("text"))


def q_text_preview(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", T.preview("text").alias("preview"))


def q_doc_titles(spark, sf):
    docs = I.corpus_documents(spark, sf)
    stem = F.regexp_replace("file_name", r"\.md$", "")
    return docs.select("file_path", T.heading_title("text", stem).alias("title"))


def _corpus_chunks(spark, sf):
    return K.chunk_tokens(K.clean_documents(I.corpus_documents(spark, sf)))


def q_chunk_tokens(spark, sf):
    ch = _corpus_chunks(spark, sf)
    return ch.select("chunk_id", "file_path", "pos", F.size(T.tokens("text")).cast("bigint").alias("n_tokens"), "text")


def q_chunk_embeddings(spark, sf):
    ch = K.embed_default(_corpus_chunks(spark, sf))
    ints = F.transform("embedding", lambda x: x.cast("int").cast("string"))
    return ch.select("chunk_id", F.array_join(ints, ",").alias("vec"),
                     F.size(F.filter("embedding", lambda x: x > 0)).cast("bigint").alias("nnz"))


# ---------------------------------------------------------------- search
def every_hundredth(e):
    """The stated query set of a search over ``embeddings``: rows whose id is divisible by 100, against all rows."""
    return e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), "embedding")


def q_knn_exact(spark, sf):
    e = table(spark, sf, "embeddings")
    q = e.select(F.col("vec_id").alias("qid"), "embedding")
    hits = R.knn_exact(q, e, SELF_SEARCH_K, id_col="vec_id")
    return hits.select("qid", F.col("rank").cast("bigint").alias("rank"), "score", "vec_id")


def q_knn_lsh(spark, sf):
    e = table(spark, sf, "embeddings")
    return R.knn_lsh(every_hundredth(e), e, SELF_SEARCH_K, dim=64, id_col="vec_id").select("qid", "rank", "score", "vec_id")


def _questions(spark, sf):
    bench, pages = table(spark, sf, "benchmark"), table(spark, sf, "pages")
    sheet = S.question_sheet(bench, pages)
    questions, relevant = E.questions_long(sheet)
    inp = I.inputs(spark, sf)
    rel_main = E.main_domain_docs(relevant, inp.sites)
    return E.with_main_questions(questions, rel_main), rel_main, S.expansions(bench, pages), inp


def q_questions_long(spark, sf):
    bench, pages = table(spark, sf, "benchmark"), table(spark, sf, "pages")
    _, relevant = E.questions_long(S.question_sheet(bench, pages))
    return relevant


def q_main_domain_docs(spark, sf):
    return _questions(spark, sf)[1]


def q_expanded_queries(spark, sf):
    qs, _, ex, _ = _questions(spark, sf)
    return R.expanded_queries(qs, ex).select("qid", "search_text")


def _hits(spark, sf):
    """The search results of all scenarios, written once and read by every evaluation query."""
    qs, rel, ex, inp = _questions(spark, sf)
    hits = shared_table(spark, ("hits", EVAL_K), sf, lambda: R.batch_search(qs, ex, I.page_chunks(spark, sf, inp), EVAL_K))
    return hits, qs, rel


def q_batch_search(spark, sf):
    return _hits(spark, sf)[0].select("scenario", "qid", F.col("rank").cast("bigint").alias("rank"),
                                      F.col("retrieval_rank").cast("bigint").alias("retrieval_rank"), "score", "chunk_id", "url")


def q_reranked(spark, sf):
    h = _hits(spark, sf)[0]
    return h.where(F.col("scenario") == R.SCENARIOS[2][0]).select(
        "qid", F.col("rank").cast("bigint").alias("rank"), F.col("retrieval_rank").cast("bigint").alias("retrieval_rank"),
        "rerank_score", "chunk_id")


def _scenarios(spark):
    return spark.createDataFrame([(n,) for n, _, _ in R.SCENARIOS], "scenario string")


def q_relevance_ranks(spark, sf):
    hits, _, rel = _hits(spark, sf)
    return E.relevance_ranks(hits, rel).withColumn("match_rank", F.col("match_rank").cast("bigint"))


def _evals(spark, sf):
    hits, qs, rel = _hits(spark, sf)
    return E.eval_questions(hits, qs, rel, _scenarios(spark))


def q_eval_questions(spark, sf):
    ev = _evals(spark, sf)
    j = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "|")
    return ev.select("scenario", "qid", "retrieved_count", "n_relevant", j("found_docs").alias("found_docs"),
                     j("missing_docs").alias("missing_docs"), j("all_ranks").alias("all_ranks"), "success",
                     F.col("rank_of_first_match").cast("double").alias("rank_of_first_match"),
                     F.col("best_rank").cast("double").alias("best_rank"))


def q_scenario_metrics(spark, sf):
    return E.scenario_metrics(_evals(spark, sf))


def q_accuracy_at_k(spark, sf):
    return E.accuracy_at_k(_evals(spark, sf))


def q_accuracy_report(spark, sf):
    return E.accuracy_report(E.accuracy_at_k(_evals(spark, sf)))


def q_scenario_compare(spark, sf):
    """The four scenarios side by side: metrics plus accuracy at every k."""
    ev = _evals(spark, sf)
    return E.scenario_metrics(ev).join(E.accuracy_report(E.accuracy_at_k(ev)), "scenario")


# ---------------------------------------------------------------- records
def _records(spark, sf):
    return S.warc_records(table(spark, sf, "pages"))


def q_record_census(spark, sf):
    return Rec.record_census(_records(spark, sf))


def q_header_filter(spark, sf):
    return Rec.header_filter(_records(spark, sf), HEADER_FILTERS).select("archive", "offset", "target_uri")


def q_pdf_records(spark, sf):
    return Rec.response_only(_records(spark, sf), Rec.PDF_SELECTION).select("archive", "offset", "target_uri")


def q_header_filter_keys(spark, sf):
    """Records that each filter of a list keeps, one for every computed key."""
    recs = _records(spark, sf)
    kept = [F.struct(F.lit(f).alias("filter"), F.coalesce(Rec.header_predicate([f]), F.lit(False)).alias("kept")) for f in KEY_FILTERS]
    return recs.select(F.explode(F.array(*kept)).alias("f")).groupBy("f.filter").agg(F.count_if("f.kept").alias("n"))


def q_pdf_captures(spark, sf):
    """PDF files among the captures, without excluded names."""
    c = I.captures(spark, sf)
    named = c.where(F.col("rel_path").rlike(D.PDF_FILE_PATTERN))
    return named.where(~D.keyword_excluded(D.file_name("rel_path"), D.PDF_EXCLUDE_FILE_KEYWORDS)).select("archive", "seq", "rel_path")


def q_media_types(spark, sf):
    r = _records(spark, sf).where(F.col("warc_type") == "response")
    ct = F.col("http_headers")["content-type"]
    return r.select("archive", "offset", C.media_type(ct).alias("media_type"), C.media_params(ct)["charset"].alias("charset"))


def q_payload_digests(spark, sf):
    r = _records(spark, sf).where(F.col("warc_type") == "response")
    return Rec.payload_digests(r).select("archive", "offset", "payload_digest")


# ---------------------------------------------------------------- export / incremental
def q_document_export(spark, sf):
    return D.document_export(I.page_documents(spark, sf)).select("doc_id", "file_path", "title", "url", "url_preview",
                                                                 "retrieval_date")


def _store_and_docs(spark, sf):
    docs = I.corpus_documents(spark, sf)
    store = K.chunk_tokens(K.clean_documents(docs.where(F.col("lang") == STORED_LANG)))
    return docs, store


def q_not_indexed(spark, sf):
    """Documents that a run over one language left out, asked of the key table."""
    from tidemark.streaming import incremental as ST

    docs, store = I.corpus_documents(spark, sf), Store(spark, scratch_path(spark, "not-indexed"))
    ST.index_epoch(spark, store, "run-0", docs.where(F.col("lang") == STORED_LANG))
    ST.merge_new_keys(spark, store)
    return ST.not_indexed_yet(spark, store, docs).select("file_path")


def q_index_summary(spark, sf):
    docs, store = _store_and_docs(spark, sf)
    todo = K.not_indexed(docs, store)
    new_chunks = K.chunk_tokens(K.clean_documents(todo))
    return K.index_summary(docs, new_chunks, store)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "site_list": q_site_list,
    "domain_map": q_domain_map,
    "base_site": q_base_site,
    "base_url": q_base_url,
    "suffix_repair": q_suffix_repair,
    "numbered_paths": q_numbered_paths,
    "url_matches": q_url_matches,
    "normalized_urls": q_normalized_urls,
    "archive_path": q_archive_path,
    "captures": q_captures,
    "capture_key": q_capture_key,
    "folder_key": q_folder_key,
    "page_url_variants": q_page_url_variants,
    "dropped_lines_total": q_dropped_lines_total,
    "normalized_name": q_normalized_name,
    "fingerprint": q_fingerprint,
    "dedup_captures": q_dedup_captures,
    "latest_captures": q_latest_captures,
    "allowed_pages": q_allowed_pages,
    "denied_pages": q_denied_pages,
    "domain_summary": q_domain_summary,
    "dup_counts": q_dup_counts,
    "keyword_excluded": q_keyword_excluded,
    "page_titles": q_page_titles,
    "page_text": q_page_text,
    "html_documents": q_html_documents,
    "page_urls": q_page_urls,
    "retrieval_dates": q_retrieval_dates,
    "conversion_summary": q_conversion_summary,
    "documents_union": q_documents_union,
    "pdf_documents": q_pdf_documents,
    "pdf_summary": q_pdf_summary,
    "long_lines_dropped": q_long_lines_dropped,
    "garbage_cleaned": q_garbage_cleaned,
    "doc_titles": q_doc_titles,
    "text_preview": q_text_preview,
    "chunk_tokens": q_chunk_tokens,
    "chunk_embeddings": q_chunk_embeddings,
    "knn_exact": q_knn_exact,
    "questions_long": q_questions_long,
    "main_domain_docs": q_main_domain_docs,
    "expanded_queries": q_expanded_queries,
    "batch_search": q_batch_search,
    "reranked": q_reranked,
    "relevance_ranks": q_relevance_ranks,
    "eval_questions": q_eval_questions,
    "scenario_metrics": q_scenario_metrics,
    "accuracy_at_k": q_accuracy_at_k,
    "accuracy_report": q_accuracy_report,
    "scenario_compare": q_scenario_compare,
    "record_census": q_record_census,
    "header_filter": q_header_filter,
    "pdf_records": q_pdf_records,
    "header_filter_keys": q_header_filter_keys,
    "pdf_captures": q_pdf_captures,
    "media_types": q_media_types,
    "payload_digests": q_payload_digests,
    "document_export": q_document_export,
    "not_indexed": q_not_indexed,
    "index_summary": q_index_summary,
}
