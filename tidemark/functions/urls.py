"""URL and path expressions (built-in Spark functions only, codegen-friendly).

Every function takes and returns a ``Column`` so callers can use them inside
``select``/``where``/join conditions and Catalyst keeps them in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes and names the URL rules look at.
INDEX_FILE = "index.html"
NORMALIZE_STRIP_SUFFIXES = [".html", ".htm", ".pdf", ".md"]
NORMALIZE_STRIP_INDEX = ["/index.html", "/index.htm"]

_RFC3986 = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_suffix(col: Column, suffix: str) -> Column:
    """Remove ``suffix`` once when ``col`` ends with it (one reference to ``col``)."""
    import re

    return F.regexp_replace(col, re.escape(suffix) + "$", "")


# Every helper below is a linear chain: each step reads the previous one once,
# so expression trees (and generated code) stay small however they are nested.
def base_site(url: Column | str) -> Column:
    """Base site of a URL: host without scheme, port, path, ``dns:``/``mailto:``,
    a leading ``www``/``wwwN.`` label and one trailing dot.  Empty result -> null.

    ``http://http://x`` style URLs use the part after the second ``//``.
    """
    s = F.regexp_replace(_c(url), r"^(?s).*?//", "")
    s = F.regexp_replace(s, r"^http://", "")
    s = F.replace(F.replace(s, F.lit("dns:"), F.lit("")), F.lit("mailto:"), F.lit(""))
    s = F.regexp_replace(s, r"^www[0-9]*\.", "")
    s = F.split_part(F.split_part(s, F.lit(":"), F.lit(1)), F.lit("/"), F.lit(1))
    return F.nullif(F.regexp_replace(s, r"\.$", ""), F.lit(""))


def base_url(url: Column | str) -> Column:
    """Scheme + ``//`` + host part of a URL; a URL without ``//`` is returned as is."""
    u = _c(url)
    return F.coalesce(F.nullif(F.regexp_extract(u, r"^(?s)(.*?//[^/]*)", 1), F.lit("")), u)


def url_host(url: Column | str) -> Column:
    """Lower-cased network location (``host[:port]``) of an absolute URL, '' if none."""
    return F.lower(F.regexp_extract(_c(url), _RFC3986, 4))


def url_scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_c(url), _RFC3986, 2))


def url_path(url: Column | str) -> Column:
    """Path of a URL (no query, no fragment)."""
    return F.regexp_extract(_c(url), _RFC3986, 5)


def normalize_url(url: Column | str) -> Column:
    """URL form used for relevance matching.

    Trim; drop ``;params`` of the last path segment, the query and the fragment;
    lower-case; drop one trailing ``/``; then ``/index.html`` or ``/index.htm``;
    then one of ``.html .htm .pdf .md``.  Blank -> null.
    """
    u = F.trim(_c(url))
    s = F.concat(
        F.regexp_extract(u, _RFC3986, 1),
        F.regexp_extract(u, _RFC3986, 3),
        F.regexp_replace(F.regexp_extract(u, _RFC3986, 5), r";[^/]*$", ""),
    )
    s = F.regexp_replace(F.lower(s), r"/$", "")
    s = F.regexp_replace(s, r"/index\.html?$", "")
    s = F.regexp_replace(s, r"\.(html|htm|pdf|md)$", "")
    return F.nullif(s, F.lit(""))


def urls_match(a_norm: Column, b_norm: Column) -> Column:
    """Two normalized URLs match when equal or when either contains the other."""
    return (
        a_norm.isNotNull()
        & b_norm.isNotNull()
        & ((a_norm == b_norm) | (F.instr(a_norm, b_norm) > 0) | (F.instr(b_norm, a_norm) > 0))
    )


def strip_first_www(host: Column) -> Column:
    """Remove the first ``www.`` occurrence anywhere in ``host``."""
    p = F.instr(host, "www.")
    return F.when(p == 0, host).otherwise(
        F.concat(F.substring(host, F.lit(1), p - 1), F.substring(host, p + 4, 1 << 30))
    )


def with_archive_path_parts(df, url_col: str, prefix: str = "_u", keep_query: bool = False):
    """Add ``{prefix}host``, ``{prefix}dir`` and ``{prefix}file``: the on-disk layout
    of a target URI.  URL-decoded (``+`` kept), query and fragment dropped; a last
    segment without a dot becomes a directory holding ``index.html``; dots in the
    directory become ``-``; the host loses its first ``www.``; dots in the file
    name except the last become ``-``.

    Each intermediate is its own column, so every regex runs once per row (the
    optimizer does not inline an expensive expression into several consumers).
    """
    p = prefix
    u = F.col(url_col)
    out = df.withColumn(f"{p}dec", F.coalesce(F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B"))), u))
    out = out.withColumn(f"{p}h0", F.lower(F.regexp_extract(f"{p}dec", r"^(([^:/?#]+):)?(//(?:[^/?#@]*@)?([^/?#:]*))", 4)))
    out = out.withColumn(f"{p}path", F.regexp_extract(f"{p}dec", _RFC3986, 5))
    out = out.withColumn(f"{p}f0", F.regexp_extract(f"{p}path", r"([^/]*)$", 1))
    no_dot = F.instr(F.col(f"{p}f0"), ".") == 0
    as_dir = F.regexp_replace(F.concat(F.col(f"{p}path"), F.lit("#")), r"/?#$", "/")
    out = out.withColumn(f"{p}host", strip_first_www(F.col(f"{p}h0")))
    out = out.withColumn(f"{p}dir", F.replace(
        F.when(no_dot, as_dir).otherwise(F.regexp_extract(f"{p}path", r"^(.*/)?", 1)), F.lit("."), F.lit("-")))
    out = out.withColumn(f"{p}file", F.regexp_replace(
        F.when(no_dot, F.lit(INDEX_FILE)).otherwise(F.col(f"{p}f0")), r"\.(?=[^.]*\.)", "-"))
    if keep_query:
        # a query string becomes part of the name (short digest before the suffix),
        # so ?id=1 and ?id=2 are separate files instead of numbered duplicates
        q = F.regexp_extract(f"{p}dec", _RFC3986, 7)
        tagged = F.regexp_replace(F.col(f"{p}file"), r"(\.[^.]*)$", F.concat(F.lit("-q"), F.substring(F.md5(q), 1, 8), F.lit("$1")))
        out = out.withColumn(f"{p}file", F.when(q != "", tagged).otherwise(F.col(f"{p}file")))
    return out.drop(f"{p}dec", f"{p}h0", f"{p}path", f"{p}f0")


def archive_dir_and_file(url: Column | str) -> tuple[Column, Column, Column]:
    """Column form of :func:`with_archive_path_parts` for small inputs and tests."""
    u = F.replace(_c(url), F.lit("+"), F.lit("%2B"))
    decoded = F.coalesce(F.try_url_decode(u), _c(url))
    host = strip_first_www(F.lower(F.regexp_extract(decoded, r"^(([^:/?#]+):)?(//([^/?#:]*))", 4)))
    path = F.regexp_extract(decoded, _RFC3986, 5)
    file0 = F.regexp_extract(path, r"([^/]*)$", 1)
    no_dot = F.instr(file0, ".") == 0
    as_dir = F.regexp_replace(F.concat(path, F.lit("#")), r"/?#$", "/")
    directory = F.replace(F.when(no_dot, as_dir).otherwise(F.regexp_extract(path, r"^(.*/)?", 1)), F.lit("."), F.lit("-"))
    file2 = F.regexp_replace(F.when(no_dot, F.lit(INDEX_FILE)).otherwise(file0), r"\.(?=[^.]*\.)", "-")
    return host, directory, file2
