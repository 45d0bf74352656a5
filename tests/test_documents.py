"""Document assembly, markdown conversion, export numbering, incremental index."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunks as K
from tidemark.operators import documents as D
from tidemark.operators import markdown as M


def test_pdf_assembly(spark):
    pages = spark.createDataFrame([
        (1, "a.pdf", 0, "first¬\npage"), (1, "a.pdf", 1, "   "), (1, "a.pdf", 2, "third \\ page"),
        (2, "b.pdf", 0, " \n "),
    ], "file int, file_name string, page_no int, text string")
    got = {r.file: r for r in D.pdf_documents(pages).collect()}
    assert got[1].status == "converted"
    assert got[1].text == "# PDF Document: a.pdf\n\n## Page 1\n\nfirstpage\n## Page 3\n\nthird  page"
    assert got[2].status == "skipped" and got[2].text is None


def test_page_urls(spark):
    df = spark.createDataFrame([("https://e.ch", "de/x/index.html"), ("https://e.ch/", "index.html"),
                                ("https://e.ch", "a/b.html"), (None, "a.html")], "b string, p string")
    url, prev = D.page_urls(F.col("p"), F.col("b"))
    got = [tuple(r) for r in df.select(url, prev).collect()]
    assert got == [("https://e.ch/de/x/index.html", "https://e.ch/de/x"), ("https://e.ch/index.html", "https://e.ch"),
                   ("https://e.ch/a/b.html", "https://e.ch/a/b.html"), (None, None)]


def test_markdown_rules():
    html = ("<html><head><title>T</title><meta name='Description' content='d'>"
            "<link rel='canonical' href='https://e.ch/x'></head><body><h1>Top</h1><h3>Sub</h3>"
            "<p>see <a href='/y'>link</a></p><ul><li>one</li><li>two</li></ul><script>x()</script></body></html>")
    md = M.html_to_markdown(html)
    assert md.startswith("---\ntitle: T\nmeta-description: d\ncanonical: https://e.ch/x\n---\n")
    assert "Top\n===" in md and "### Sub" in md and "see [link](/y)" in md and "* one\n* two" in md
    assert "x()" not in md


def test_document_export_numbering(spark):
    docs = spark.createDataFrame([(f"d/{i:03d}.md", "t") for i in range(57)], "file_path string, text string")
    docs = docs.repartition(5)
    for c in ["file_name", "domain", "title", "url", "url_preview", "source"]:
        docs = docs.withColumn(c, F.lit(None).cast("string"))
    docs = docs.withColumn("retrieval_date", F.lit(None).cast("timestamp_ntz"))
    out = D.document_export(docs).orderBy("doc_id").collect()
    assert [r.doc_id for r in out] == list(range(57))
    assert [r.file_path for r in out] == sorted(f"d/{i:03d}.md" for i in range(57))
    assert out[0].url == "" and out[0].retrieval_date == ""


def test_incremental_equals_full(spark):
    docs = spark.createDataFrame([(f"k{i}", "d", " ".join(["w"] * (i * 300))) for i in range(1, 6)],
                                 "file_path string, domain string, text string")
    full = K.chunk_tokens(K.clean_documents(docs))
    first = K.chunk_tokens(K.clean_documents(docs.where("file_path in ('k1','k2')")))
    rest = K.chunk_tokens(K.clean_documents(K.not_indexed(docs, first)))
    both = sorted(r.chunk_id for r in first.unionByName(rest).collect())
    assert both == sorted(r.chunk_id for r in full.collect())


def test_adaptive_embed_splits_and_loses_nothing():
    calls, seen = [], []

    def fn(texts):
        calls.append(len(texts))
        if len(texts) > 2 or any(len(t) > 5000 for t in texts):
            raise ValueError("400 input too large")
        seen.extend(texts)
        return [[float(len(t)), 1.0] for t in texts]

    long = " ".join(f"word{i}" for i in range(2500))
    out = K.adaptive_embed(fn, ["a", "b", "c", "d", long, ""])
    assert calls[0] == 6 and len(long) > 20000
    parts = [t for t in seen if len(t) > 1]
    assert sorted("".join(parts)) == sorted(long) and all(len(t) <= 5000 for t in parts)
    assert [v[0] for v in out[:4]] == [1.0] * 4 and out[5] == [0.0, 1.0]
    assert abs(out[4][1] - 1.0) < 1e-9 and abs(out[4][0] - sum(len(t) ** 2 for t in parts) / len(long)) < 1e-6


def test_adaptive_embed_tells_errors_apart():
    import pytest

    with pytest.raises(K.CountMismatch):
        K.adaptive_embed(lambda texts: [[1.0]] * 400, ["a", "b"])
    with pytest.raises(ValueError, match="413"):
        K.adaptive_embed(lambda texts: (_ for _ in ()).throw(ValueError("413 too large")), ["a"])


def test_write_chunks_dynamic_overwrite(spark):
    import tempfile

    path = tempfile.mkdtemp(prefix="chunks-test-") + "/t"
    a = spark.createDataFrame([("a#0", "x", "d1"), ("b#0", "y", "d2")], "chunk_id string, text string, domain string")
    K.write_chunks(a, path, mode="overwrite")
    b = spark.createDataFrame([("c#0", "z", "d1")], "chunk_id string, text string, domain string")
    K.write_chunks(b, path, mode="overwrite")   # replaces domain d1 only
    got = sorted((r.domain, r.chunk_id) for r in spark.read.parquet(path).collect())
    assert got == [("d1", "c#0"), ("d2", "b#0")]


def test_embed_with_failed_chunk_drops_document(spark):
    docs = spark.createDataFrame([("ok", "d", "alpha beta"), ("bad", "d", "POISON gamma")],
                                 "file_path string, domain string, text string")
    chunks = K.chunk_tokens(docs)

    def model(texts):
        if any("POISON" in t for t in texts):
            raise ValueError("model rejected the input")
        return [[1.0, float(len(t))] for t in texts]

    vecs = K.embed_with(chunks, model, batch_rows=8)
    errors = {r.file_path: r.error for r in vecs.collect()}
    assert errors["ok"] is None and "rejected" in errors["bad"]
    kept = K.drop_failed_documents(chunks, vecs)
    assert [r.file_path for r in kept.collect()] == ["ok"]
    # the failed document has no stored chunk, so the next run picks it up again
    assert [r.file_path for r in K.not_indexed(docs, kept).collect()] == ["bad"]


def test_incremental_content_key(spark):
    old = K.with_content_key(spark.createDataFrame([("a", "d", "v1 text"), ("b", "d", "same")],
                                                   "file_path string, domain string, text string"))
    store = K.chunk_tokens(K.clean_documents(old))
    new = K.with_content_key(spark.createDataFrame([("a", "d", "v2 text"), ("b", "d", "same")],
                                                   "file_path string, domain string, text string"))
    assert K.not_indexed(new, store).count() == 0                                   # path key: nothing to do
    assert [r.file_path for r in K.not_indexed(new, store, ["file_path", "content_md5"]).collect()] == ["a"]


def test_markdown_and_text_paths_yield_same_documents(spark, sf):
    from tidemark.plans import indexing as I

    inp = I.inputs(spark, sf)
    latest = I.latest_pages(spark, sf, inp)
    md = sorted(r.file_path for r in M.markdown_documents(latest, inp.domains).select("file_path").collect())
    txt = sorted(r.file_path for r in D.pages_to_documents(latest, inp.domains).select("file_path").collect())
    assert md == txt and len(md) > 0


def test_model_is_made_once_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        with open(f"{folder}/made", "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda texts: [[float(len(t)), float(os.getpid())] for t in texts]

    rows = [(f"d{i}#0", f"d{i}", "x" * i) for i in range(40)]
    chunks = spark.createDataFrame(rows, "chunk_id string, file_path string, text string").repartition(12)
    got = K.embed_with(chunks, factory=factory, batch_rows=2).collect()
    made = open(f"{folder}/made").read().split()
    assert len(made) == len(set(made)) < 12 and {str(int(r.embedding[1])) for r in got} <= set(made)
    assert sorted(r.embedding[0] for r in got) == [float(i) for i in range(40)]
    with pytest.raises(ValueError, match="either"):
        K.embed_with(chunks)


def test_only_selected_pages_are_converted_and_each_once(spark):
    records = spark.createDataFrame([("a", i, f"page {i}") for i in range(20)], "archive string, seq long, body string")
    chosen = spark.createDataFrame([("a", 3, "d", "x.html", "200"), ("a", 5, "d", "y.html", "200")], "archive string, seq long, domain string, rel_path string, http_status string")
    latest = chosen.join(records, ["archive", "seq"]).withColumn("capture_ts", F.lit(None).cast("timestamp_ntz"))
    domains = spark.createDataFrame([("d", "http://d")], "domain string, base_url string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(body):
        seen.add(1)
        return body.upper() if body != "page 5" else "Redirecting"

    docs = D.pages_to_documents(latest, domains, text_fn=text).collect()
    assert [(r.file_path, r.text) for r in docs] == [("d/x.md", "PAGE 3")]
    assert seen.value == 2
