"""Documents: page filters, text conversion, URL/title metadata, PDF page assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.session import materialise

# Exclusion lists used by the page conversion jobs.
HTML_EXCLUDE_FILE_KEYWORDS = [
    "impressum", "datenschutz", "kontakt", "robots",
    "imprint", "data-protection", "contact", "copyright",
    "login", "search", "suche",
]
PDF_EXCLUDE_FILE_KEYWORDS = [
    "impressum", "datenschutz", "kontakt", "robots",
    "imprint", "data-protection", "contact", "copyright",
]
# Domains to skip are deployment-specific (sites known to break conversion):
# a parameter, empty by default.
EXCLUDE_DOMAINS: list[str] = []
HTML_FILE_PATTERN = r"\.(html|htm|html\.gz)$"
PDF_FILE_PATTERN = r"\.(pdf|pdf\.gz)$"
DEFAULT_SOURCE = "webarchive"
PDF_TITLE_PREFIX = "# PDF Document: "
EXAMPLES_PER_STATUS = 20


def file_name(path: Column | str) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]*)$", 1)


def keyword_excluded(name: Column | str, keywords: list[str]) -> Column:
    """True when the lower-cased file name contains any keyword."""
    n = F.lower(F.col(name) if isinstance(name, str) else name)
    kw = F.array(*[F.lit(k) for k in keywords])
    return F.exists(kw, lambda k: F.instr(n, k) > 0)


def markdown_rel_path(rel_path: Column | str) -> Column:
    """``x.html.gz`` -> ``x.md``; any other file -> stem + ``.md``."""
    p = F.col(rel_path) if isinstance(rel_path, str) else rel_path
    return F.when(p.endswith(".html.gz"), F.concat(F.substring(p, F.lit(1), F.length(p) - 8), F.lit(".md"))).when(
        p.endswith(".pdf.gz"), F.concat(F.substring(p, F.lit(1), F.length(p) - 7), F.lit(".md"))
    ).otherwise(F.concat(F.regexp_replace(p, r"(?<=[^/])\.[^./]*$", ""), F.lit(".md")))


def page_path_from_md(md_rel: Column) -> Column:
    """Markdown path back to the page path: ``.md`` suffix -> ``.html``."""
    return F.concat(F.regexp_replace(md_rel, r"\.md$", ""), F.lit(".html"))


def page_urls(page_path: Column, base_url: Column, base_path: str | None = None) -> tuple[Column, Column]:
    """(url, url_preview) from the domain's base URL and the page path.

    ``…/index.html`` previews as its directory, a root ``index.html`` as the base URL.
    A null base URL (domain not mapped) gives null URLs; a null page path (a file at the
    root of the tree) gives the base URL itself.  ``base_path`` goes in front of the page
    path, for a tree of one forced domain that starts below its root.
    """
    if base_path:
        page_path = F.concat(F.lit(base_path.rstrip("/") + "/"), page_path)
    base = F.when(base_url.endswith("/"), base_url).otherwise(F.concat(base_url, F.lit("/")))
    url = F.concat(base, page_path)
    base_trim = F.regexp_replace(base, r"/+$", "")
    preview = (
        F.when(page_path.endswith("/index.html"),
               F.when(F.length(page_path) > 11, F.concat(base, F.substring(page_path, F.lit(1), F.length(page_path) - 11))).otherwise(base_trim))
        .when(page_path == "index.html", base_trim)
        .otherwise(url)
    )
    at_root = page_path.isNull()
    return F.when(at_root, base_url).otherwise(url), F.when(at_root, base_url).otherwise(preview)


def convert_status(text: Column) -> Column:
    """converted / skipped (empty or redirect-only) / failed (no text)."""
    return F.when(text.isNull(), "failed").when(text.isin("", T.REDIRECT_TEXT), "skipped").otherwise("converted")


def html_documents(pages_latest: DataFrame, domains: DataFrame, sites: DataFrame | None = None,
                   exclude_domains: list[str] | None = None, exclude_keywords: list[str] | None = None,
                   source: str = DEFAULT_SOURCE, text_fn=None, status: str | None = None) -> DataFrame:
    """Newest captures -> documents with URL, preview, capture date, title.

    ``text_fn(body_string_column) -> Column`` converts the page; the default is
    the regex text extractor (all built-in).  Filters run before the
    conversion so no excluded page is ever converted.
    """
    exclude_domains = EXCLUDE_DOMAINS if exclude_domains is None else exclude_domains
    exclude_keywords = HTML_EXCLUDE_FILE_KEYWORDS if exclude_keywords is None else exclude_keywords
    df = pages_latest.where(F.col("rel_path").rlike(HTML_FILE_PATTERN))
    if status is not None:  # error pages are indexed unless a status is required
        df = df.where(F.col("http_status") == status)
    df = df.where(~keyword_excluded(file_name("rel_path"), exclude_keywords))
    if exclude_domains:
        df = df.where(~F.col("domain").isin(exclude_domains))
    if sites is not None:
        s = sites.select(F.col("domain").alias("_site"))
        df = df.join(s, F.col("domain") == F.col("_site"), "left_semi")
    text_fn = text_fn or T.html_text
    body = F.col("body").cast("string")
    # the text comes out of a generator, so that no later filter on it is pushed below the join
    # with the bodies, where every capture that was not selected would be converted too
    conv = df.select(
        "domain", "rel_path", "capture_ts", "archive",
        F.explode(F.array(text_fn(body))).alias("text"),
    )
    conv = conv.withColumn("status", convert_status(F.col("text")))
    return conv


def with_metadata(docs: DataFrame, domains: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Add file_path, file_name, title, url, url_preview, retrieval_date, kind, source."""
    md = markdown_rel_path("rel_path")
    dm = domains.select(F.col("domain").alias("_d"), F.col("base_url"))
    joined = docs.join(dm, F.col("domain") == F.col("_d"), "left").drop("_d")
    page_path = page_path_from_md(md)
    url, preview = page_urls(page_path, F.col("base_url"))
    stem = F.regexp_replace(file_name(md), r"\.md$", "")
    return joined.select(
        F.concat(F.col("domain"), F.lit("/"), md).alias("file_path"),
        file_name(md).alias("file_name"),
        "domain",
        T.heading_title(F.col("text"), stem).alias("title"),
        F.lit(source).alias("source"),
        url.alias("url"),
        preview.alias("url_preview"),
        F.col("capture_ts").alias("retrieval_date"),
        F.lit("html").alias("kind"),
        "text",
        F.col("rel_path").alias("_page"),
    )


def newest_per_key(docs: DataFrame, key_col: str = "file_path") -> DataFrame:
    """One document per key: ``x.html`` and ``x.html.gz`` both become ``x.md``;
    the newest capture wins, then the smaller page path (pre-aggregated min_by)."""
    cols = docs.columns
    ts_num = F.date_format("retrieval_date", "yyyyMMddHHmmss").cast("bigint")
    order = F.struct(F.col("retrieval_date").isNull(), -ts_num, F.col("_page"))
    return docs.groupBy(key_col).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row")).select("_row.*")


def pages_to_documents(pages_latest: DataFrame, domains: DataFrame, sites: DataFrame | None = None,
                       text_fn=None, **kw) -> DataFrame:
    conv = html_documents(pages_latest, domains, sites, text_fn=text_fn, **kw)
    docs = with_metadata(conv.where(F.col("status") == "converted").drop("status"), domains)
    return newest_per_key(docs).drop("_page")


def conversion_summary(converted: DataFrame) -> DataFrame:
    """converted / skipped / failed per domain, plus the overall row (domain null)."""
    s = F.col("status")
    return converted.rollup("domain").agg(
        F.count_if(s == "converted").alias("converted"),
        F.count_if(s == "skipped").alias("skipped"),
        F.count_if(s == "failed").alias("failed"),
    )


# ---------------------------------------------------------------- PDF pages
def pdf_documents(pages: DataFrame, file_col: str = "file", page_col: str = "page_no", text_col: str = "text",
                  name_col: str = "file_name", files: DataFrame | None = None) -> DataFrame:
    """Page texts -> one markdown text per file, with a status per file; ``files`` (the same
    file and name columns) lists files that may have no page at all.

    Pages with non-blank text, in page order, each under ``## Page i`` (1-based),
    joined by newline; soft-hyphen breaks and backslashes removed, stripped;
    ``# PDF Document: name`` heads the text.  No page -> skipped, no text -> skipped.
    """
    p = pages.select(
        F.col(file_col).alias("file"), F.col(name_col).alias("file_name"),
        F.col(page_col).alias("page_no"), F.col(text_col).alias("text"),
    )
    part = F.when(~T.is_blank(F.coalesce(F.col("text"), F.lit(""))),
                  F.concat(F.lit("## Page "), (F.col("page_no") + 1).cast("string"), F.lit("\n\n"), F.col("text")))
    agg = p.groupBy("file", "file_name").agg(
        F.count("*").alias("n_pages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", part.alias("part")))),
                                 lambda e: e["part"]), "\n").alias("body"),
    )
    if files is not None:
        listed = files.select(F.col(file_col).alias("file"), F.col(name_col).alias("file_name")).distinct()
        agg = listed.join(agg, ["file", "file_name"], "left").withColumn("n_pages", F.coalesce("n_pages", F.lit(0).cast("bigint")))
    cleaned = T.strip_pdf_artifacts(F.coalesce(F.col("body"), F.lit("")))
    return agg.select(
        "file", "file_name", "n_pages",
        F.when(F.col("n_pages") == 0, "skipped").when(cleaned == "", "skipped").otherwise("converted").alias("status"),
        F.when(F.col("n_pages") == 0, "Empty Page Count").when(cleaned == "", "No Text Extracted").alias("reason"),
        F.when(cleaned != "", F.concat(F.lit(PDF_TITLE_PREFIX), F.col("file_name"), F.lit("\n\n"), cleaned)).alias("text"),
    )


def pdf_summary(pdf_docs: DataFrame, n_examples: int = EXAMPLES_PER_STATUS) -> DataFrame:
    """Count per status and up to ``n_examples`` example files (sorted) with their reason.

    The example list is bounded before it is collected: a per-status top-n
    (``row_number() <= n``, planned as a partial group limit) feeds the list.
    """
    ex = F.concat(F.col("file"), F.lit("  ["), F.coalesce(F.col("reason"), F.lit("")), F.lit("]"))
    counts = pdf_docs.groupBy("status").agg(F.count("*").alias("files"))
    w = Window.partitionBy("status").orderBy("file")
    top = pdf_docs.where(F.col("status") != "converted").select("status", "file", ex.alias("example"), F.row_number().over(w).alias("rn")).where(F.col("rn") <= n_examples)
    lists = top.groupBy("status").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", "example"))), lambda s: s["example"]), "\n").alias("examples"))
    return counts.join(lists, "status", "left")


# ---------------------------------------------------------------- export
def document_export(docs: DataFrame, order_col: str = "file_path") -> DataFrame:
    """Rows with a gap-free global ``doc_id`` in ``order_col`` order, blanks for missing metadata.

    Only the keys are sorted: range-partitioned and stored with their range, numbered
    inside it, and moved on by the counts of the ranges before (one row per range).
    The numbers are then joined to the documents, so texts move once.  ``order_col``
    is the documents' key; a repeated or null key is numbered once."""
    keys = docs.select(order_col).distinct().repartitionByRange(order_col).withColumn("_range", F.spark_partition_id())
    keys = materialise(keys, "export-order")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keys.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order_col))
    ids = keys.withColumn("_at", inside).join(F.broadcast(offsets), "_range").select(
        F.col(order_col).alias("_key"), (F.col("_off") + F.col("_at") - 1).cast("bigint").alias("doc_id"))
    numbered = docs.join(ids, F.col(order_col).eqNullSafe(F.col("_key")))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return numbered.select(
        "doc_id", blank("file_path").alias("file_path"), blank("file_name").alias("file_name"),
        blank("domain").alias("domain"), blank("title").alias("title"), blank("url").alias("url"),
        blank("url_preview").alias("url_preview"),
        F.coalesce(F.date_format("retrieval_date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("")).alias("retrieval_date"),
        F.col("text").alias("content"), F.coalesce(F.col("source"), F.lit(DEFAULT_SOURCE)).alias("source"),
    )


def pdf_to_documents(pdf_docs: DataFrame, domain: str = "pdf") -> DataFrame:
    """Converted PDF texts in the document shape (key ``domain/name.md``, kind ``pdf``)."""
    ok = pdf_docs.where(F.col("status") == "converted")
    md = F.regexp_replace("file_name", r"\.pdf(\.gz)?$", ".md")
    return ok.select(
        F.concat(F.lit(domain + "/"), md).alias("file_path"), md.alias("file_name"), F.lit(domain).alias("domain"),
        F.regexp_replace(md, r"\.md$", "").alias("title"), F.lit(DEFAULT_SOURCE).alias("source"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("url_preview"),
        F.lit(None).cast("timestamp_ntz").alias("retrieval_date"), F.lit("pdf").alias("kind"), "text")


def all_documents(html_docs: DataFrame, pdf_docs: DataFrame) -> DataFrame:
    """HTML and PDF documents in one table; ``kind`` is part of the identity, so
    ``a.html`` and ``a.pdf`` never overwrite each other."""
    return html_docs.unionByName(pdf_docs, allowMissingColumns=True)


def write_captures(captures: DataFrame, path: str) -> None:
    """Capture sink: files partitioned by domain; rebalancing splits a huge site into
    as many tasks as its size asks for and puts small ones together."""
    captures.hint("rebalance", F.col("domain")).write.mode("overwrite").partitionBy("domain").parquet(path)


def write_markdown_tree(docs: DataFrame, root: str) -> DataFrame:
    """Markdown sink: one ``root/<file_path>`` file per document, written by the
    task holding the row (``pyarrow.fs``, so cluster storage works).  A path is
    a pure function of the key, so a retried task rewrites the same files.
    Returns ``(file_path, bytes)`` per written file."""
    import pandas as pd

    root = root.rstrip("/")

    def write(it):
        import pyarrow.fs as pafs

        for pdf in it:
            paths, sizes = [], []
            for key, text in zip(pdf["file_path"], pdf["text"]):
                target = f"{root}/{key}"
                if "://" in target and not target.startswith("file:"):
                    fs, p = pafs.FileSystem.from_uri(target)
                else:
                    fs, p = pafs.LocalFileSystem(), target.replace("file://", "").replace("file:", "")
                fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                data = (text or "").encode("utf-8")
                with fs.open_output_stream(p, compression=None) as fh:
                    fh.write(data)
                paths.append(key)
                sizes.append(len(data))
            yield pd.DataFrame({"file_path": paths, "bytes": sizes})

    return docs.select("file_path", "text").mapInPandas(write, "file_path string, bytes bigint")


def with_retrieval_time(docs: DataFrame, times: DataFrame, folder_col: str = "folder", path_col: str = "file_path") -> DataFrame:
    """Add ``retrieval_date`` and ``time_source`` from an imported map ``times`` (page, retrieved): page path -> capture time.

    Pages and documents meet by their markdown path, so ``x.html``, ``x.html.gz`` and
    ``x.md`` are one.  Of several times of a page the document gets the last one not after the
    stamp of its folder, or the last one if the folder has none or they are all later.  Documents
    that the map lacks (or has no readable time for) get the folder's stamp, and null without
    one; ``time_source`` is map, folder or none.  The map's times of a page are gathered before the
    join, so a document meets one row."""
    from tidemark.operators.captures import capture_ts

    name = F.regexp_extract("page", r"([^/]*)$", 1)
    path = F.concat(F.regexp_extract("page", r"^(.*/)?[^/]*$", 1), markdown_rel_path(name))
    known = times.select(path.alias("__page"), F.try_to_timestamp("retrieved").cast("timestamp_ntz").alias("at")).filter("at is not null")
    known = known.groupBy("__page").agg(F.array_sort(F.collect_set("at")).alias("__at"))
    out = docs.withColumn("__stamp", capture_ts(folder_col)).join(known, F.col(path_col) == F.col("__page"), "left")
    before = F.filter("__at", lambda t: t <= F.col("__stamp"))
    mapped = F.coalesce(F.array_max(before), F.array_max("__at"))
    return out.withColumns({
        "retrieval_date": F.coalesce(mapped, F.col("__stamp")),
        "time_source": F.when(mapped.isNotNull(), "map").when(F.col("__stamp").isNotNull(), "folder").otherwise("none"),
    }).drop("__stamp", "__page", "__at")
