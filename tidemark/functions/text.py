"""Text expressions: line filters, garbage cleanup, titles, chunking, HTML text.

All are Spark SQL built-ins (regexes, higher-order array functions) so they run
inside whole-stage codegen without a Python worker.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _whitespace_class() -> str:
    """Regex class body of every code point Python's ``str.isspace`` accepts.

    Built from the rule instead of a table so the class tracks the Unicode
    database of the running interpreter; Java and RE2 both read ``\\x{..}``.
    """
    points = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    ranges: list[tuple[int, int]] = []
    for p in points:
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1] = (ranges[-1][0], p)
        else:
            ranges.append((p, p))
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:X}}}" if lo == hi else f"\\x{{{lo:X}}}-\\x{{{hi:X}}}")
    return "".join(parts)


WS = _whitespace_class()            # class body (no brackets), Python whitespace
NON_WS = f"[^{WS}]"
IS_WS = f"[{WS}]"
# Same set for Java with one property lookup per character: under (?U) ``\s`` is
# Unicode White_Space, which is Python's set without U+001C..U+001F.
FAST_NON_WS = r"[^\s\x{1C}-\x{1F}]"
FAST_WS = r"[\s\x{1C}-\x{1F}]"

# Fixed values of the cleaning and chunking rules.
MAX_LINE_CHARS = 1000
GARBAGE_RUN = 100
REPEAT_MIN = 11           # one character followed by 10 or more copies
REPEAT_KEEP = 3
CHUNK_TOKENS = 512
CHUNK_OVERLAP = 64
PREVIEW_CHARS = 150
TITLE_SCAN_LINES = 5
REDIRECT_TEXT = "Redirecting"


def split_lines(text: Column | str) -> Column:
    return F.split(_c(text), "\n", -1)


def drop_long_lines(text: Column | str, max_chars: int = MAX_LINE_CHARS) -> Column:
    """Remove every line longer than ``max_chars`` characters."""
    return F.array_join(F.filter(split_lines(text), lambda l: F.length(l) <= max_chars), "\n")


def count_long_lines(text: Column | str, max_chars: int = MAX_LINE_CHARS) -> Column:
    return F.size(F.filter(split_lines(text), lambda l: F.length(l) > max_chars))


def clean_garbage(text: Column | str) -> Column:
    """Delete runs of >=100 non-space characters, then shrink any character
    repeated 11+ times in a row (newline excluded) to three copies."""
    # A run can only start where the previous character is whitespace (or at the
    # start), so anchoring there with a lookbehind gives the same matches while
    # each word is scanned once instead of once per start position.
    nw = FAST_NON_WS
    no_runs = F.regexp_replace(_c(text), f"(?U)(?<!{nw}){nw}{{{GARBAGE_RUN}}}{nw}*+", "")
    return F.regexp_replace(no_runs, f"(?d)(.)\\1{{{REPEAT_MIN - 1},}}", "$1" * REPEAT_KEEP)


def is_blank(text: Column | str) -> Column:
    """True when the text holds nothing but (Unicode) whitespace."""
    return _c(text).rlike(f"(?U)^{FAST_WS}*$")


def py_strip(text: Column | str) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_c(text), f"(?U)^{FAST_WS}+|{FAST_WS}+$", "")


def heading_title(text: Column | str, fallback: Column | str) -> Column:
    """First line among the first five whose stripped form starts with ``# ``
    (every ``# `` then removed), else ``fallback``."""
    first = F.slice(split_lines(text), 1, TITLE_SCAN_LINES)
    heads = F.filter(F.transform(first, py_strip), lambda l: l.startswith("# "))
    return F.coalesce(F.replace(F.get(heads, 0), F.lit("# "), F.lit("")), _c(fallback))


def preview(text: Column | str, n: int = PREVIEW_CHARS) -> Column:
    return F.concat(F.substring(_c(text), 1, n), F.lit("..."))


def tokens(text: Column | str) -> Column:
    """Whitespace tokens (the chunker's unit)."""
    return F.filter(F.split(_c(text), f"(?U){FAST_WS}+"), lambda t: t != "")


def chunk_starts(n_tokens: Column, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Token offsets of the windows: every ``size - overlap`` tokens until the end is covered."""
    stride = size - overlap
    return F.when(n_tokens <= 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.greatest(n_tokens - overlap - 1, F.lit(0)), F.lit(stride))
    )


def token_windows(toks: Column, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of ``size`` tokens overlapping by ``overlap``, joined by a space."""
    return F.transform(
        chunk_starts(F.size(toks), size, overlap),
        lambda s: F.array_join(F.slice(toks, s + 1, size), " "),
    )


def chunk_texts(text: Column | str, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of chunk strings: windows of ``size`` tokens overlapping by ``overlap``."""
    return token_windows(tokens(text), size, overlap)


def strip_pdf_artifacts(text: Column | str) -> Column:
    """Remove soft hyphen line breaks (``¬`` + newline) and backslashes, then strip."""
    t = F.replace(_c(text), F.lit("¬\n"), F.lit(""))
    t = F.replace(t, F.lit("\\"), F.lit(""))
    return py_strip(t)


# HTML to plain text with regexes only (the SQL-checkable converter).
HTML_DROP_BLOCKS = [r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->"]
HTML_BREAK_TAGS = r"(?i)</?(p|div|h[1-6]|li|ul|ol|br|tr|table|article|section|nav|header|footer|title|main|aside)(\s[^>]*)?/?>"
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def html_text(html: Column | str) -> Column:
    """Visible text of an HTML page: scripts, styles and comments removed, block
    tags become line breaks, other tags vanish, common entities decoded,
    blank runs collapsed."""
    t = _c(html)
    for pat in HTML_DROP_BLOCKS:
        t = F.regexp_replace(t, pat, "")
    t = F.regexp_replace(t, HTML_BREAK_TAGS, "\n")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    for ent, ch in HTML_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    t = F.regexp_replace(t, r"[ \t\r]+", " ")
    t = F.regexp_replace(t, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(t, r"^[ \n]+|[ \n]+$", "")


def html_title(html: Column | str) -> Column:
    return F.trim(F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1))
