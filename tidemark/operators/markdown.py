"""HTML page -> markdown document, as an Arrow-batched job over page bodies.

Our own conversion rules (standard-library ``html.parser``): front matter from
``<title>``, ``<link rel=canonical>`` and ``<meta name=...>``; ``h1``/``h2``
underlined (``=``/``-``), deeper headings as ``###``...; ``* `` list items;
``[text](href)`` links; paragraphs separated by a blank line; script, style
and template content dropped.  One page never breaks the job: a page that
cannot be converted gets status ``failed``.
"""

from __future__ import annotations

import gzip
from html.parser import HTMLParser
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKIP_TAGS = {"script", "style", "noscript", "template", "svg"}
BLOCK_TAGS = {"p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "table", "tr", "ul", "ol",
              "blockquote", "pre", "form"}


class _Markdown(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.line: list[str] = []
        self.skip = 0
        self.heading = 0
        self.href: str | None = None
        self.link_text: list[str] = []
        self.in_title = False
        self.title = ""
        self.meta: dict[str, str] = {}

    def _flush(self, blank: bool = True):
        text = " ".join("".join(self.line).split())
        self.line = []
        if not text:
            return
        if self.heading in (1, 2):
            self.out.append(text)
            self.out.append(("=" if self.heading == 1 else "-") * len(text))
        elif self.heading:
            self.out.append("#" * self.heading + " " + text)
        else:
            self.out.append(text)
        if blank:
            self.out.append("")

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in SKIP_TAGS:
            self.skip += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "meta" and a.get("name") and a.get("content") is not None:
            self.meta["meta-" + a["name"].lower()] = a["content"]
        elif tag == "link" and a.get("rel") and a.get("href"):
            rel = a["rel"].lower()
            self.meta["canonical" if rel == "canonical" else "link-" + rel] = a["href"]
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._flush()
            self.heading = int(tag[1])
        elif tag == "li":
            self._flush(blank=False)
            self.line.append("* ")
        elif tag == "br":
            self._flush(blank=False)
        elif tag in BLOCK_TAGS:
            self._flush()
        elif tag == "a":
            self.href = a.get("href")
            self.link_text = []

    def handle_endtag(self, tag):
        if tag in SKIP_TAGS:
            self.skip = max(0, self.skip - 1)
        elif tag == "title":
            self.in_title = False
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._flush()
            self.heading = 0
        elif tag == "li":
            self._flush(blank=False)
        elif tag in BLOCK_TAGS:
            self._flush()
        elif tag == "a" and self.href is not None:
            text = " ".join("".join(self.link_text).split())
            self.line.append(f"[{text}]({self.href})" if text else "")
            self.href = None

    def handle_data(self, data):
        if self.skip:
            return
        if self.in_title:
            self.title += data
            return
        if self.href is not None:
            self.link_text.append(data)
        else:
            self.line.append(data)

    def markdown(self) -> str:
        self._flush()
        body = "\n".join(self.out).strip()
        front = {"title": " ".join(self.title.split())} if self.title.strip() else {}
        front.update(self.meta)
        if not front:
            return body
        head = "\n".join(f"{k}: {v}" for k, v in front.items())
        return f"---\n{head}\n---\n\n{body}" if body else ""


def html_to_markdown(html: str) -> str:
    p = _Markdown()
    p.feed(html)
    p.close()
    return p.markdown()


def decode_body(body: bytes | str | None, name: str = "") -> str:
    """Bytes -> text: gunzip ``.gz`` names, UTF-8 dropping undecodable bytes."""
    if body is None:
        return ""
    if isinstance(body, str):
        return body
    if name.endswith(".gz"):
        try:
            body = gzip.decompress(body)
        except OSError:
            pass
    return body.decode("utf-8", errors="ignore")


def convert_pages(pages: DataFrame, key_col: str = "rel_path", body_col: str = "body") -> DataFrame:
    """Add ``status`` (converted/skipped/failed) and ``markdown`` to each page row.

    Runs as ``mapInPandas``: place every filter before this step, Catalyst does
    not push predicates through a Python stage.
    """
    keep = [c for c in pages.columns if c != body_col]
    schema = pages.select(*keep).schema.add("status", "string").add("markdown", "string")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            status, texts = [], []
            for name, body in zip(pdf[key_col], pdf[body_col]):
                try:
                    md = html_to_markdown(decode_body(body, str(name)))
                    st = "skipped" if md in ("", "Redirecting") else "converted"
                except Exception:  # noqa: BLE001 - one page never breaks the job
                    md, st = None, "failed"
                status.append(st)
                texts.append(md if st == "converted" else None)
            out = pdf[keep].copy()
            out["status"] = status
            out["markdown"] = texts
            yield out

    return pages.mapInPandas(run, schema)



def pages_markdown(pages_latest: DataFrame) -> DataFrame:
    conv = convert_pages(pages_latest.select("domain", "rel_path", "capture_ts", "body"))
    return conv.withColumn("n_chars", F.length("markdown"))


def markdown_documents(pages_latest: DataFrame, domains: DataFrame, sites: DataFrame | None = None,
                       exclude_domains: list[str] | None = None, exclude_keywords: list[str] | None = None,
                       status: str | None = None) -> DataFrame:
    """Newest captures -> markdown documents with URL, preview, capture date, title.

    Same filters as the text path, applied before the Python conversion; then the
    same metadata and one-document-per-key rule."""
    from tidemark.operators import documents as D

    exclude_domains = D.EXCLUDE_DOMAINS if exclude_domains is None else exclude_domains
    exclude_keywords = D.HTML_EXCLUDE_FILE_KEYWORDS if exclude_keywords is None else exclude_keywords
    df = pages_latest.where(F.col("rel_path").rlike(D.HTML_FILE_PATTERN))
    df = df.where(~D.keyword_excluded(D.file_name("rel_path"), exclude_keywords))
    if exclude_domains:
        df = df.where(~F.col("domain").isin(exclude_domains))
    if status is not None:
        df = df.where(F.col("http_status") == status)
    if sites is not None:
        df = df.join(sites.select(F.col("domain").alias("_site")), F.col("domain") == F.col("_site"), "left_semi")
    conv = convert_pages(df.select("domain", "rel_path", "capture_ts", "archive", "body"))
    ok = conv.where(F.col("status") == "converted").withColumnRenamed("markdown", "text").drop("status")
    docs = D.with_metadata(ok, domains)
    return D.newest_per_key(docs).drop("_page")
