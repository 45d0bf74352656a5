"""Packing of tokenised documents along a space-filling curve.

A document's token counts, hashed to a short vector, are projected to three
dimensions and put on a Hilbert curve.  Documents are range-sorted along it and laid
end to end; the line of tokens is cut every ``length`` tokens.  What remains at its
end is cut at powers of two, which need no padding."""

from __future__ import annotations

import functools
import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, stored, vocabulary

LENGTH = 2048
#: The id behind each document.
END = 1
#: Hashed dimensions, dimensions of the curve, bits of each.
HASHED, DIMS, BITS = 256, 3, 16
#: Words kept with their ids in a Python worker (a full table starts anew, which costs time only), and bytes encoded at once.
CACHE_WORDS, SLICE = 300_000, 8 << 20
#: Marks that often end a word; a run of them is a piece of its own to the tokenizer.
MARKS = ".,;:!?"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """Ids of texts by a file of the tokenizers library, as its plain call gives them: a special token's string in a text is that token.

    The tokenizer's pieces never cross white space, so each different word of a slice is
    encoded once.  A word of letters alone, with marks behind it or not, is one piece (and
    one for its marks): its lower-cased letters go to the file's model directly.  All
    other words go through the whole tokenizer."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # the short way holds for a tokenizer that normalises and cuts words as this one does
        self.short_way = self._pieces(["Straße.", "ÉCOLE", "abc!?"]) == [self._whole([w])[0] for w in ("Straße.", "ÉCOLE", "abc!?")]
        self.known: dict[str, bytes] = {}

    def _whole(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _letters(self, core: str) -> bytes:
        word = core if core.isascii() else "".join(BYTE_LETTERS[b] for b in core.encode())
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def _pieces(self, words: list[str]) -> list[bytes]:
        return [self._letters(w.rstrip(MARKS).lower()) + (self._whole([w[len(w.rstrip(MARKS)) :]])[0]) for w in words]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian bytes."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known, out, other = self.known, [b""] * len(words), []
        for i, w in enumerate(words):
            core = w.rstrip(MARKS)
            plain = core.isalpha() and self.short_way and (
                core.isascii() or (unicodedata.is_normalized("NFC", core) and not any(c in core for c in NOT_ALONE)))
            if not plain:
                other.append(i)
                continue
            key = core.lower()
            if (ids := known.get(key)) is None:
                ids = known[key] = self._letters(key)
            if len(core) < len(w):
                marks = w[len(core) :]
                if (end := known.get(marks)) is None:
                    end = known[marks] = self._whole([marks])[0]
                ids += end
            out[i] = ids
        new = [i for i in other if words[i] not in known]
        for i, ids in zip(new, self._whole([words[i] for i in new])):
            known[words[i]] = ids
        for i in other:
            out[i] = known[words[i]]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= SLICE):
                size += len(texts[upto])
                upto += 1
            out += self._slice(texts[at:upto])
            at = upto
        return out

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = lists.flatten().dictionary_encode()
        ids = self.word_ids(words.dictionary.to_pylist())
        values = np.frombuffer(b"".join(ids), dtype=self.dtype)
        kind = np.int32 if len(texts) > 1 else np.int64  # a slice of several texts is small
        sizes = np.fromiter(map(len, ids), dtype=kind, count=len(ids)) // self.dtype.itemsize
        starts = np.cumsum(sizes, dtype=kind) - sizes
        which = words.indices.to_numpy()
        n = sizes[which]
        ends = np.cumsum(n, dtype=kind)
        place = np.repeat(starts[which] - (ends - n), n)
        place += np.arange(len(place), dtype=kind)
        cut = np.concatenate(([0], ends))[lists.offsets.to_numpy()[1:-1] - lists.offsets[0].as_py()]
        return np.split(values[place], cut)


BYTE_LETTERS = _byte_letters()
#: Letters whose lower case depends on their neighbours or on the library.
NOT_ALONE = "\u03a3\u0130"


def _encoder(path: str | None) -> Encoder:
    return vocabulary(("packing", path), lambda: Encoder(path))


def hilbert(coords: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of non-negative integer coordinates (below 2**bits) on the Hilbert curve.

    The coordinates are turned into the transposed Hilbert index by undoing, from
    the highest bit down, the reflections and exchanges of the curve's sub-cubes."""
    x = [coords[:, i].astype(np.uint64) for i in range(coords.shape[1])]
    n, one = len(x), np.uint64(1)
    q = np.uint64(1 << (bits - 1))
    while q > one:
        p = q - one
        for i in range(n):
            up = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(up, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = np.where(up, x[i], x[i] ^ t)
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > one:
        t = np.where((x[-1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x = [v ^ t for v in x]
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << one) | ((v >> np.uint64(b)) & one)
    return key.astype(np.int64)


@functools.lru_cache(maxsize=1)
def _projection(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(HASHED, size=size), rng.choice([-1.0, 1.0], size=size), rng.standard_normal((HASHED, DIMS))


def curve_keys(ids: list[np.ndarray], size: int) -> np.ndarray:
    """Hilbert key of each document's hashed token counts (log-damped, length-normalised, projected)."""
    place, sign, plane = _projection(size)
    rows = np.zeros((len(ids), HASHED))
    for r, v in enumerate(ids):
        rows[r] = np.bincount(place[v], weights=sign[v], minlength=HASHED)
    rows = np.sign(rows) * np.log1p(np.abs(rows))
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    unit = 1 / (1 + np.exp(-1.7 * (rows @ plane)))
    return hilbert(np.minimum(unit * (1 << BITS), (1 << BITS) - 1).astype(np.int64))


def tokenised(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Add ``tokens``: (ids as little-endian bytes with the end id, their number, the curve key)."""

    @F.pandas_udf("struct<ids:binary,n:long,curve:long>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = _encoder(tokenizer)
        end = np.array([END], dtype=enc.dtype).tobytes()
        for texts in batches:
            ids = enc.encode([t or "" for t in texts])
            curve = curve_keys(ids, enc.tokenizer.get_vocab_size())
            yield pd.DataFrame({"ids": [i.tobytes() + end for i in ids], "n": [len(i) + 1 for i in ids], "curve": curve})
        give_back()

    return docs.withColumn("tokens", encode(F.col(text_col)))


def blocks(total: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, size) of the sequences behind the last full one: the rest of the line as falling powers of two."""
    at, out = total - total % length, []
    rest = total % length
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def cuts(start: int, n: int, total: int, tail: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(start in document, size, sequence, offset there) of the pieces of a document on the line at ``start``."""
    full = total // length
    out, at, stop = [], start, start + n
    while at < stop:
        if at < full * length:
            seq, lo, hi = at // length, at - at % length, at - at % length + length
        else:
            k, (lo, size) = next((k, b) for k, b in enumerate(tail) if at < b[0] + b[1])
            seq, hi = full + k, lo + size
        end = min(stop, hi)
        out.append((at - start, end - at, seq, at - lo))
        at = end
    return out


def pack(docs: DataFrame, text_col: str = "text", length: int = LENGTH, tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, unless not wanted, ids.

    Every row of ``docs`` (doc_id, text) is a document, also a repeated one; a null or
    empty text is the end id alone; a very long text is tokenised in one task, a slice of
    its words at a time being kept, and lies in as many sequences as it fills.  Ties on the curve are ordered by the order of the
    stored rows.  No documents give no rows; more columns are ignored.  Only the last
    sequences, at most eleven of falling powers of two, are shorter than ``length``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lines = stored(
        # as text, ids of any size and null pass through Python unchanged
        tokenised(docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text_col).alias("text")), "text", tokenizer)
        .select("doc_id", "tokens.*").withColumn("row", F.monotonically_increasing_id()), "tokens")
    ranged = stored(
        lines.select("curve", "row", "n").repartitionByRange("curve", "row").withColumn("range", F.spark_partition_id()), "curve")
    sums = ranged.groupBy("range").agg(F.sum("n").alias("sum"))
    # one row per range: bounded by the number of partitions
    before = sums.select("range", F.coalesce(F.sum("sum").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("curve", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum("n").over(inside)).join(F.broadcast(before), "range").select(
        "row", (F.col("before") + F.col("upto") - F.col("n")).alias("at"))
    total = sums.agg(F.sum("sum")).first()[0] or 0
    tail = blocks(total, length)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, raw, n, at in zip(b["doc_id"], b["ids"], b["n"], b["at"]):
                ids = np.frombuffer(raw, dtype=f"<u{len(raw) // int(n)}").astype("<u4")
                for s, size, seq, off in cuts(int(at), int(n), total, tail, length):
                    own = ids[s : s + size]
                    piece = (doc, s, size, zlib.crc32(own.tobytes()), int(n), seq, off)
                    out.append((*piece, own.astype(np.int32)) if with_ids else piece)
            yield pd.DataFrame(out, columns=names)
        give_back()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = "doc_id string, " + ", ".join(f"{c} long" for c in names[1:7]) + ", ids array<int>" * with_ids
    return lines.select("row", "doc_id", "ids", "n").join(placed, "row").select("doc_id", "ids", "n", "at").mapInPandas(pieces, schema).withColumn(
        "doc_id", F.col("doc_id").cast(kind))
