"""Cleaning, titles and chunking against plain-Python statements of the rules."""

import re

from pyspark.sql import functions as F

from tidemark.functions import text as T


def py_clean(text):
    lines = [l for l in text.split("\n") if len(l) <= 1000]
    t = "\n".join(lines)
    t = re.sub(r"\S{100,}", "", t)
    return re.sub(r"(.)\1{10,}", r"\1\1\1", t)


EDGE_TEXTS = [
    "a" * 10 + " " + "b" * 11 + " " + "c" * 30,
    "x" * 99 + " " + "y" * 100 + " tail",
    "line\n" + "z" * 1000 + "\n" + "w" * 1001 + "\nend",
    "   \t",
    "r\r\r\r\r\r\r\r\r\r\r\r\rs",
    "emoji \U0001F600\U0001F600\U0001F600\U0001F600\U0001F600\U0001F600\U0001F600\U0001F600\U0001F600\U0001F600\U0001F600 ok",
    "nn\n\n\n\n\n\n\n\n\n\n\n\nmm",
    "word " * 60 + "q" * 120,
]


def test_clean_garbage_matches_python(spark):
    df = spark.createDataFrame([(t,) for t in EDGE_TEXTS], "t string")
    got = [r[0] for r in df.select(T.clean_garbage(T.drop_long_lines("t"))).collect()]
    assert got == [py_clean(t) for t in EDGE_TEXTS]


def test_blank_and_strip(spark):
    vals = ["   \t", "  x ", "　y　", ""]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    rows = df.select(T.is_blank("t"), T.py_strip("t")).collect()
    assert [r[0] for r in rows] == [not v.strip() for v in vals]
    assert [r[1] for r in rows] == [v.strip() for v in vals]


def test_long_line_count(spark):
    t = "a\n" + "b" * 1000 + "\n" + "c" * 1001 + "\n" + "d" * 5000
    df = spark.createDataFrame([(t,)], "t string")
    assert df.select(T.count_long_lines("t")).first()[0] == 2


def test_heading_title(spark):
    df = spark.createDataFrame([("intro\n  # My Title # x\nmore", "stem"), ("1\n2\n3\n4\n5\n# late", "stem"),
                                (None, "s")], "t string, s string")
    got = [r[0] for r in df.select(T.heading_title("t", F.col("s"))).collect()]
    assert got == ["My Title x", "stem", "s"]


def py_chunks(text, size=512, overlap=64):
    toks = text.split()
    if not toks:
        return []
    out, start = [], 0
    while True:
        out.append(" ".join(toks[start:start + size]))
        if start + size >= len(toks):
            return out
        start += size - overlap


def test_chunk_windows(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 511, 512, 513, 960, 961, 2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [list(r[0]) for r in df.select(T.chunk_texts("t")).collect()]
    assert got == [py_chunks(t) for t in texts]


def test_html_text_and_title(spark):
    html = ("<html><head><title> A &amp; B </title><style>p{}</style><script>var t='</p>';</script></head>"
            "<body><!-- c --><h1>Head</h1><p>One <b>two</b></p><ul><li>x</li></ul></body></html>")
    df = spark.createDataFrame([(html,)], "h string")
    text, title = df.select(T.html_text("h"), T.html_title("h")).first()
    assert title == "A &amp; B"
    assert text == "A & B\nHead\nOne two\nx"


def test_fast_whitespace_class_equals_python(spark):
    """Every code point: Java's (?U) class agrees with Python's str.isspace."""

    chars = "".join(chr(c) for c in range(0, 0x3100) if not 0xD800 <= c <= 0xDFFF)
    df = spark.createDataFrame([(chars,)], "t string")
    kept = df.select(F.regexp_replace("t", f"(?U){T.FAST_NON_WS}", "")).first()[0]
    assert kept == "".join(c for c in chars if c.isspace())
