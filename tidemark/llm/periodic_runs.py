"""Periodic runs of words by descending-LCP Kruskal.

The suffixes of a document that share their first words form classes.  Neighbours in
suffix order are united by decreasing length of what they share (LCP), with a union-find
whose classes keep their positions in order, the smaller class going into the larger.
Two positions that become neighbours inside a class share exactly the current LCP; when
their distance is small against it, the words between them repeat.  Such a pair with
different words before its two places starts a maximal run, and its distance is the
smallest period: with a smaller one another position of the class would lie between."""

from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, in_slices, numbered
from .shingles import mix

#: A run holds at least so many words and so many periods.
LEAST, POWER = 24, 3
#: A smaller class is merged with a pass over the larger one from this share on, else word by word.
MERGE = 16

U = np.uint64
RUNS = "array<struct<start:long,length:long,period:long>>"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of characters other than ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def suffix_order(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a sequence in the order of their suffixes, and how many codes each shares with the next one, by prefix doubling."""
    n = len(code)
    rank = np.unique(code, return_inverse=True)[1].astype(np.int32)
    levels, k = [rank], 1
    while True:
        pair = rank.astype(np.int64) * (n + 1)
        pair[: n - k] += rank[k:] + 1  # nothing behind the end comes first
        values, rank = np.unique(pair, return_inverse=True)
        rank = rank.astype(np.int32)
        if len(values) == n:
            break
        levels.append(rank)
        k *= 2
    place = np.empty(n, dtype=np.int64)
    place[rank] = np.arange(n)
    a, b = place[:-1], place[1:]
    shared = np.zeros(max(n - 1, 0), dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = np.flatnonzero(np.maximum(x, y) < n)
        same = inside[levels[j][x[inside]] == levels[j][y[inside]]]
        shared[same] += 1 << j
    return place, shared


def seeds(place: np.ndarray, shared: np.ndarray, floor: int) -> Iterator[tuple[int, int, int]]:
    """(place, distance, shared words) of every pair of places that become neighbours in a class at ``shared`` >= ``floor``."""
    edges = np.flatnonzero(shared >= floor)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, list[int]] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for edge, lcp in zip(edges.tolist(), shared[edges].tolist()):
        x, y = find(edge), find(edge + 1)
        large, small = classes.pop(x, None) or [int(place[x])], classes.pop(y, None) or [int(place[y])]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        last = -1  # neighbours only where no other place of the smaller class lies between
        for j, p in enumerate(small):
            i = bisect(large, p)
            if i and large[i - 1] > last:
                yield large[i - 1], p - large[i - 1], lcp
            if i < len(large) and (j + 1 == len(small) or large[i] < small[j + 1]):
                yield p, large[i] - p, lcp
            last = p
        if MERGE * len(small) > len(large):
            large = sorted(large + small)  # two sorted runs are merged in one pass
        else:
            for p in small:
                insort(large, p)
        classes[x] = large
        parent[y] = x


def find_runs(code: np.ndarray, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of codes, by start, then period.

    A run is a stretch with smallest period q, at least ``power`` * q and ``least`` long
    (``power`` >= 2), that can't be extended keeping q."""
    if len(code) < least:
        return []
    # a run shares all but its first period with itself: at least this much
    floor = -(-least * (power - 1) // power)
    place, shared = suffix_order(code)
    out = []
    for p, d, lcp in seeds(place, shared, floor):
        if d + lcp >= max(least, power * d) and (p == 0 or code[p - 1] != code[p + d - 1]):
            out.append((p, d + lcp, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _repeating(code: np.ndarray, doc: np.ndarray, least: int, power: int) -> np.ndarray:
    """Documents that hold a stretch of words twice that is as long as what any run shares with itself (hash collisions only add some)."""
    width = -(-least * (power - 1) // power)
    if len(code) <= width:
        return np.zeros(0, dtype=np.int64)
    h = mix(code.astype(U) + (doc.astype(U) << U(32)))  # of the next 1, 2, 4, ... words
    size = 1
    while 2 * size <= width:
        h = mix(h[:-size] * U(0x9E3779B97F4A7C15) + h[size:])
        size *= 2
    if width > size:
        h = mix(h[: len(h) - (width - size)] * U(0xC2B2AE3D27D4EB4F) + h[width - size :])
    own = doc[: len(h)] == doc[width - 1 :]
    h, where = h[own], doc[: len(h)][own]
    order = np.argsort(h, kind="stable")
    twice = order[1:][h[order[1:]] == h[order[:-1]]]
    return np.unique(where[twice])


def runs_of(docs: list[list[bytes]], least: int = LEAST, power: int = POWER) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    sizes = np.array([len(w) for w in docs], dtype=np.int64)
    if not sizes.sum():
        return out
    code = numbered([w for d in docs for w in d])[0]
    doc = np.repeat(np.arange(len(docs)), sizes)
    starts = np.cumsum(sizes) - sizes
    for k in _repeating(code, doc, least, power):
        out[k] = find_runs(code[starts[k] : starts[k] + sizes[k]], least, power)
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by a space, without those that a run holds behind its first period."""
    if runs:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; of ties the first by start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """Add ``runs`` (start, length and period in words, by start, then period), ``top`` and ``collapsed`` to each document.

    ``top`` is the run of most periods (ties: smallest start, then period), null without
    runs; ``collapsed`` the words joined by one space, without those that any run holds
    behind its first period.  Null and empty texts have no runs and collapse to the empty
    text; input columns of these three names are replaced, others pass through; repeated
    rows each get the same result; an empty table gives an empty one.  Texts are taken
    whole; one that repeats itself is sorted in one task, with about 60 bytes a word and 4
    more for each doubling of its longest repeat."""

    @F.pandas_udf(f"struct<runs:{RUNS},top:struct<start:long,length:long,period:long>,collapsed:string>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("start", "length", "period")
        for b in batches:
            texts = b.tolist()
            rows = []
            for lo, hi in in_slices(texts):
                words = [words_of(t) for t in texts[lo:hi]]
                for w, r in zip(words, runs_of(words, least, power)):
                    top = strongest(r)
                    rows.append(([dict(zip(names, x)) for x in r], dict(zip(names, top)) if top else None, collapse(w, r)))
            yield pd.DataFrame(rows, columns=["runs", "top", "collapsed"])
        give_back()

    kept = [c for c in docs.columns if c.lower() not in ("runs", "top", "collapsed")]
    return docs.select(*kept, look(F.col(text_col)).alias("__found")).select(*kept, "__found.*")


def plant_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rewrite about a tenth of the texts so that their ends repeat, by a fixed recipe (the data of the query).

    With h the crc32 of the decimal id and g = floor(h / 10), a text of n > 0 words with
    h % 10 = 0 keeps its first a = g % n words; each later word i becomes word
    a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)).  Rows without id stay as they are."""

    @F.pandas_udf("string")
    def planted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hashes, texts in batches:
            out = texts.tolist()
            for k in np.flatnonzero((hashes.fillna(1).astype("int64") % 10 == 0).to_numpy()):
                words, g = words_of(out[k]), int(hashes.iloc[k]) // 10
                if n := len(words):
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    unit = words[a : a + p]
                    words[a:] = (unit * ((n - a) // p + 1))[: n - a]
                    out[k] = b" ".join(words).decode("utf-8", "surrogatepass")
            yield pd.Series(out, dtype=object)

    return docs.withColumn(text_col, planted(F.crc32(F.col(id_col).cast("string")), F.col(text_col)))
