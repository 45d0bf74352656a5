"""Which character set a page's bytes are in, and the text in it, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Byte order marks, and the names by which pages call the sets that Spark decodes.
MARKS = [("efbbbf", "UTF-8"), ("fffe", "UTF-16LE"), ("feff", "UTF-16BE")]
NAMES = {
    "utf-8": "UTF-8", "utf8": "UTF-8", "utf-16": "UTF-16LE", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE", "us-ascii": "ISO-8859-1", "ascii": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1", "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "iso_8859-1": "ISO-8859-1", "windows-1252": "ISO-8859-1", "cp1252": "ISO-8859-1",
}
#: Bytes in which a meta tag is looked for.
META_BYTES = 1024
#: The set of bytes that aren't UTF-8 and that nothing names a set for.
OTHERWISE = "ISO-8859-1"


def _known(name: Column) -> Column:
    pairs = [F.lit(x) for kv in NAMES.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(name)))


def _mark(body: Column) -> Column:
    head = F.lower(F.hex(F.substring(body, 1, 3)))
    out = F.lit(None).cast("string")
    for mark, name in reversed(MARKS):
        out = F.when(head.startswith(mark), name).otherwise(out)
    return out


def charset(body: Column, content_type: Column | None = None) -> Column:
    """The character set of a body: byte order mark, else the declared one (``content_type`` header), else
    that of a meta tag, else UTF-8 if the bytes are valid, else ISO-8859-1.  Declared names that aren't known are passed
    over, as is a declared UTF-8 that the bytes contradict.  Null bodies have none."""
    declared = _known(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?i)charset\s*=\s*[\"']?([^\s;\"']+)", 1)) if content_type is not None else F.lit(None)
    # bytes above 0x7F in the head stand for themselves, so that the tag can be read whatever the set
    head = F.decode(F.substring(body, 1, META_BYTES), "ISO-8859-1")
    meta = _known(F.regexp_extract(head, r"(?is)<meta[^>]*?charset\s*=\s*[\"']?([^\s;\"'/>]+)", 1))
    valid = F.is_valid_utf8(body.cast("string"))
    usable = lambda c: F.when((c != "UTF-8") | valid, c)
    # a tag that could be read byte by byte isn't in a two-byte set
    one_byte = F.when(~meta.startswith("UTF-16"), meta)
    return F.when(body.isNotNull(), F.coalesce(_mark(body), usable(declared), usable(one_byte), F.when(valid, F.lit("UTF-8")), F.lit(OTHERWISE)))


def decoded(body: Column, name: Column) -> Column:
    """The text of a body in the set ``name`` (of :func:`charset`), without its byte order mark; bytes that are no
    character become U+FFFD, an odd last byte of a two-byte set goes."""
    even = F.substring(body, F.lit(1), (F.octet_length(body) / 2).cast("int") * 2)
    text = (
        F.when(name == "UTF-8", F.make_valid_utf8(body.cast("string")))
        .when(name == "UTF-16LE", F.decode(even, "UTF-16LE")).when(name == "UTF-16BE", F.decode(even, "UTF-16BE"))
        .otherwise(F.decode(body, "ISO-8859-1")))
    return F.regexp_replace(text, "^﻿", "")
