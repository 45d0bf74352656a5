"""Secret scans: fixed patterns and a token-efficiency test.

Prose packs several characters into each token of a byte-pair vocabulary; random
strings do not.  A long run of key-like characters is a secret when it holds few
characters per token, unless it is a digest or identifier of a known shape.  Runs of
letters, hyphenated words and paths are judged by the same ratio, over those of their
parts that are no single token."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, vocabulary

KINDS = ["assign", "access", "hex", "token"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Runs that the efficiency test looks at.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])")
#: Known digests (MD5, SHA-1, SHA-256, SHA-512 in hex), UUIDs, plain numbers and dates.
KNOWN = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9+/_=-]+)"
)
#: Letters alone, or letters with up to four digits behind them between separators: paths, hyphenated words, keys of such a shape.
WORDS = re.compile(r"(?:[A-Za-z]*[/_=-])*[A-Za-z]*|(?:[A-Za-z]*[0-9]{0,4}[/_=-])+[A-Za-z]*[0-9]{0,4}")
PART = re.compile(r"[A-Za-z]+")
#: A run is random when it has at most so many characters per token.
MAX_RATIO = 2.3

SPAN = "struct<kind:string,start:int,end:int>"


def _load(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encoder(path: str | None):
    return vocabulary(("secrets", path), lambda: _load(path))


def _random_words(run: str, encoding, max_ratio: float) -> bool:
    """Whether the letters of a run of word shape are random: parts that are a token are words, in any case of theirs.

    The other parts must hold at least half of the run's letters and few characters per token."""
    parts = PART.findall(run)
    tokens = [min(len(encoding.encode_ordinary(p)), len(encoding.encode_ordinary(p.lower()))) for p in parts]
    rest = [(len(p), n) for p, n in zip(parts, tokens) if n > 1]
    size = sum(n for n, _ in rest)
    return 2 * size >= sum(map(len, parts)) and 0 < size <= max_ratio * sum(n for _, n in rest)


def find_spans(text: str, ranks: str | None = None, max_ratio: float = MAX_RATIO) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, ordered by start, then by kind as in KINDS."""
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            out.append((m.start(), 0, m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 20:
            out.append((m.start(), 1, m.end()))
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if KNOWN.fullmatch(run):
            continue
        encoding = _encoder(ranks)
        if len(run) <= max_ratio * len(encoding.encode_ordinary(run)) and (not WORDS.fullmatch(run) or _random_words(run, encoding, max_ratio)):
            out.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def scan(docs: DataFrame, text_col: str = "text", out: str = "secrets", ranks: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """Add ``out``: array of (kind, start, end) spans of each whole text, in code points, end exclusive.

    Null and empty texts have no spans; an input column named ``out`` is replaced;
    repeated rows stay repeated; a very long text is scanned whole in one call, in memory of
    its own size; an empty table gives an empty one.  ``ranks`` is the path of a tiktoken rank file."""

    @F.pandas_udf(f"array<{SPAN}>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t or "", ranks, max_ratio)] for t in texts], dtype=object)
        give_back()

    return docs.withColumn(out, spans(F.col(text_col)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined in order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", ranks: str | None = None) -> DataFrame:
    """Replace every secret of a text by ``mark`` (overlapping spans as one); null texts stay null."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else _cleaned(t, mark, ranks) for t in texts], dtype=object)
        give_back()

    return docs.withColumn(text_col, clean(F.col(text_col)))


def _cleaned(text: str, mark: str, ranks: str | None) -> str:
    out, at = [], 0
    for _, s, e in find_spans(text, ranks):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def digest(spans: list[tuple[str, int, int]]) -> str:
    """sha256 of the base spans of a list, as the query reports it (for tests)."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans if k != "token").encode()).hexdigest()
