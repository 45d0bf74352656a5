"""Exact repeats by sorted suffixes, over whole texts as bytes.

A byte is a repeat when some string of LENGTH bytes over it starts at another place
too.  Every such string names one of its places (``anchors``), so it is enough to sort
the suffixes at named places, with the strings that name them:

1. hashes of named places are dealt out by range; places whose hash occurs once belong
   to no repeat;
2. the texts ship the others as contexts, the bytes of all strings that name the place;
   equal contexts are one row;
3. sampled splitters range-partition the contexts by the leading bytes of their suffix;
   suffixes with equal leading bytes share a bucket, so no repeat crosses a boundary.  A
   bucket sorts its strings by leading token, then by a fingerprint of the whole string,
   and compares neighbours.  Leading bytes with more contexts than a piece of a bucket
   holds are split further: their contexts are dealt out in batches, each batch sends a
   digest of every distinct string once, digests meet by range, and those that occur
   again come back to the batches;
4. repeats go back to all places of their context and merge to spans of each text."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, anchors
from .common import give_back, sized, stored, text_key

LENGTH = 200
#: Named places sent at once and matched by a task, and bytes of contexts sorted at once.
SENT, TASK, SORTED_BYTES = 200_000, 500_000, 1 << 20

U = np.uint64
DIGEST = np.dtype([("x", "<u8"), ("y", "<u8")])
_BYTES = np.random.default_rng(8).integers(1, 1 << 63, size=256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.ones(n, dtype=U), np.ones(n, dtype=U)
    up[1:], down[1:] = U(_BASE), U(inverse)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def repeated_windows(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context a mask over its strings of ``length`` bytes: true where the string occurs again in any of them."""
    sizes = np.array([len(c) for c in contexts])
    windows = sizes - length + 1
    joined = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    begin = np.cumsum(sizes) - sizes
    first = np.cumsum(windows) - windows
    at = np.arange(int(windows.sum())) - np.repeat(first, windows) + np.repeat(begin, windows)
    up, down = _powers(len(joined))
    sums = np.concatenate((np.zeros(1, dtype=U), np.cumsum(_BYTES[joined] * up, dtype=U)))
    print_ = (sums[at + length] - sums[at]) * down[at]
    token = np.zeros(len(joined) - 7, dtype=U)
    for k in range(8):
        token = (token << U(8)) | joined[k : len(joined) - 7 + k].astype(U)
    lead = token[at]
    order = np.lexsort((print_, lead))  # by leading token, then by the fingerprint of the whole string
    a, b = order[:-1], order[1:]
    same = np.flatnonzero((lead[a] == lead[b]) & (print_[a] == print_[b]))
    repeated = np.zeros(len(at), dtype=bool)
    view = np.lib.stride_tricks.sliding_window_view(joined, length)
    for lo in range(0, len(same), 1 << 15):  # neighbours are compared byte by byte
        i, j = a[same[lo : lo + (1 << 15)]], b[same[lo : lo + (1 << 15)]]
        equal = (view[at[i]] == view[at[j]]).all(axis=1)
        repeated[i[equal]] = True
        repeated[j[equal]] = True
    return np.split(repeated, first[1:])


def _runs(mask: np.ndarray, length: int) -> list[tuple[int, int]]:
    """(start, end) of the bytes covered by each run of marked strings."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [(int(s), int(e) - 1 + length) for s, e in zip(edge[::2], edge[1::2])]


def _merged(spans: Column) -> Column:
    """Overlapping and adjoining spans of an array as one."""

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def merge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            out = []
            for own in rows:
                whole: list[dict] = []
                for s, e in sorted((x["start"], x["end"]) for x in own):
                    if whole and s <= whole[-1]["end"]:
                        whole[-1]["end"] = max(e, whole[-1]["end"])
                    else:
                        whole.append({"start": s, "end": e})
                out.append(whole)
            yield pd.Series(out, dtype=object)

    return merge(spans)


def _repeated_places(sources: DataFrame, total: int, length: int) -> DataFrame:
    """(tid, keys): of each text the hashes of its named places that occur again, as packed arrays."""
    ranges = max(1, math.ceil(total / 80 / TASK))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0

        def out() -> pd.DataFrame:
            key, tid = (np.concatenate(c) for c in zip(*held))
            where = ((key >> U(40)).astype(np.int64) * ranges) >> 24
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(ranges + 1))
            full = [k for k in range(ranges) if cut[k + 1] > cut[k]]
            parts = [order[cut[k] : cut[k + 1]] for k in full]
            return pd.DataFrame({"range": full, "keys": [key[p].tobytes() for p in parts], "tids": [tid[p].tobytes() for p in parts]})

        for b in batches:
            for t, text in zip(b["tid"], b["text"]):
                key = anchors(_raw(text), length)[3]
                held.append((key, np.full(len(key), t, dtype=np.int64)))
                count += len(key)
                if count >= SENT:
                    yield out()
                    held, count = [], 0
        if count:
            yield out()
        held = []
        give_back()

    def again(batch: pd.DataFrame) -> pd.DataFrame:
        key = np.concatenate([np.frombuffer(x, dtype=U) for x in batch["keys"]])
        tid = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in batch["tids"]])
        order = np.argsort(key)
        key, tid = key[order], tid[order]
        near = key[1:] == key[:-1]
        twice = np.concatenate((near, [False])) | np.concatenate(([False], near))
        key, tid = key[twice], tid[twice]
        order = np.argsort(tid, kind="stable")
        key, tid = key[order], tid[order]
        cut = np.flatnonzero(np.concatenate(([True], tid[1:] != tid[:-1]))) if len(tid) else np.zeros(0, dtype=int)
        return pd.DataFrame({"tid": tid[cut], "keys": [k.tobytes() for k in np.split(key, cut[1:])] if len(cut) else []})

    sent = sources.select("tid", "text").mapInPandas(send, "range int, keys binary, tids binary")
    found = sent.groupBy("range").applyInPandas(again, "tid long, keys binary")
    return found.groupBy("tid").agg(F.collect_list("keys").alias("keys"))


def _contexts(sources: DataFrame, keys: DataFrame, length: int) -> DataFrame:
    """(c1, c2, tk, at, lead, bytes): the contexts of repeated places, their digest, and where they lie."""

    names = ["c1", "c2", "tk", "at", "lead", "bytes"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for tk, text, packed in zip(b["tk"], b["text"], b["keys"]):
                raw = _raw(text)
                whole = raw.tobytes()
                wanted = np.unique(np.concatenate([np.frombuffer(k, dtype=U) for k in packed]))
                place, first, last, key = anchors(raw, length)
                for i in np.flatnonzero(np.isin(key, wanted)):
                    context = whole[first[i] : last[i] + length]
                    d = np.frombuffer(hashlib.md5(context).digest(), dtype=np.int64)
                    out.append((d[0], d[1], tk, first[i], whole[place[i] : place[i] + GRAM], context))
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            yield pd.DataFrame(out, columns=names)
        give_back()

    # tid is a short name that texts may share by chance: such texts then ship a few contexts too many
    schema = "c1 long, c2 long, tk binary, at long, lead binary, bytes binary"
    return sources.select("tid", "tk", "text").join(keys, "tid").drop("tid").mapInPandas(cut, schema)


def _digests(context: bytes, length: int) -> np.ndarray:
    """16-byte digest of each string of ``length`` bytes of a context."""
    joined = b"".join(hashlib.md5(context[k : k + length]).digest() for k in range(len(context) - length + 1))
    return np.frombuffer(joined, dtype=DIGEST)


def _grouped(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests, which of them each one is, and how often they occur."""
    order = np.lexsort((d["y"], d["x"]))
    d = d[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d["x"][1:] != d["x"][:-1]) | (d["y"][1:] != d["y"][:-1])
    which = np.empty(len(d), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return d[new], which, np.bincount(which)


def _crowd_spans(crowd: DataFrame, total: int, length: int, piece: int) -> DataFrame:
    """(c1, c2, start, end): repeated bytes of distinct contexts of which any number may share their leading bytes.

    A batch sends each of its distinct strings once and tells its own repeats itself, so
    a string that all contexts share is one digest of each batch."""
    # about half of a context's bytes start a string; rows between batches and ranges grow with the square of their number
    batches = ranges = max(1, math.ceil(total / (4 * piece)))
    rows = crowd.withColumn("batch", F.pmod(F.xxhash64("c1", "c2"), F.lit(batches)))

    def send(b: pd.DataFrame) -> pd.DataFrame:
        found = _grouped(np.concatenate([_digests(c, length) for c in b["bytes"]]))[0]
        where = ((found["x"] >> U(40)).astype(np.int64) * ranges) >> 24
        order = np.argsort(where, kind="stable")
        cut = np.searchsorted(where[order], np.arange(ranges + 1))
        full = np.flatnonzero(cut[1:] > cut[:-1])
        return pd.DataFrame({"range": full, "batch": b["batch"].iloc[0], "digests": [found[order[cut[k] : cut[k + 1]]].tobytes() for k in full]})

    def again(b: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, dtype=DIGEST) for x in b["digests"]]
        _, which, times = _grouped(np.concatenate(parts))
        give_back()
        more = np.split(times[which] > 1, np.cumsum([len(x) for x in parts])[:-1])
        return pd.DataFrame({"batch": b["batch"], "digests": [x[m].tobytes() for x, m in zip(parts, more)]})

    def mark(b: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(b):
            elsewhere = np.concatenate([np.zeros(0, dtype=DIGEST), *(np.frombuffer(x, dtype=DIGEST) for x in told["digests"])])
            own = [_digests(c, length) for c in b["bytes"]]
            strings, which, times = _grouped(np.concatenate(own))
            _, at, either = _grouped(np.concatenate((strings, elsewhere)))
            repeated = ((times > 1) | (either[at[: len(strings)]] > 1))[which]
            masks = np.split(repeated, np.cumsum([len(x) for x in own])[:-1])
            for c1, c2, n, c, m in zip(b["c1"], b["c2"], b["times"], b["bytes"], masks):
                out += [(c1, c2, s, e) for s, e in ([(0, len(c))] if n > 1 else _runs(m, length))]
        give_back()
        return pd.DataFrame(out, columns=["c1", "c2", "start", "end"])

    sent = rows.select("batch", "bytes").groupBy("batch").applyInPandas(send, "range int, batch long, digests binary")
    told = stored(sent.groupBy("range").applyInPandas(again, "batch long, digests binary"), "crowd-strings")
    return rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(mark, "c1 long, c2 long, start long, end long")


def _bucket_spans(contexts: DataFrame, length: int, piece: int = SORTED_BYTES) -> DataFrame:
    """(c1, c2, start, end): repeated bytes of each distinct context, sorted bucket by bucket.

    No list of contexts that are sorted together has more than twice ``piece`` bytes,
    however many share their leading bytes."""

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def out(rows: list[tuple]) -> pd.DataFrame:
            masks = repeated_windows([r[4] for r in rows], length)
            found = [(r[0], r[1], s, e) for r, m in zip(rows, masks) for s, e in ([(0, len(r[4]))] if r[2] > 1 else _runs(m, length))]
            return pd.DataFrame(found, columns=["c1", "c2", "start", "end"])

        for b in batches:
            for r in zip(b["c1"], b["c2"], b["times"], b["lead"], b["bytes"]):
                if size >= piece and held[-1][3] != r[3]:  # suffixes with equal leading bytes stay together
                    yield out(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield out(held)
        give_back()

    # equal contexts combine before and after the shuffle
    once = contexts.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("times"), F.first("lead").alias("lead"), F.first("bytes").alias("bytes"))
    once = stored(once.withColumns({"place": F.xxhash64("lead"), "size": F.octet_length("bytes")}), "distinct-contexts")
    # leads of equal hash are taken together, which may only split some that need not be
    hot = stored(once.groupBy("place").agg(F.sum("size").alias("size")).filter(F.col("size") > piece), "crowded-leads")
    total = hot.agg(F.sum("size")).first()[0] or 0
    crowded = sized(hot.select("place"))
    rest = once.join(crowded, "place", "left_anti") if total else once
    schema = "c1 long, c2 long, start long, end long"
    spans = rest.select("c1", "c2", "times", "lead", "bytes").repartitionByRange("lead").sortWithinPartitions("lead").mapInPandas(sort, schema)
    if not total:
        return spans
    crowd = stored(once.join(crowded, "place", "left_semi").select("c1", "c2", "times", "bytes"), "crowded-contexts")
    return spans.unionByName(_crowd_spans(crowd, total, length, piece))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(tk, spans): repeated byte spans of each text with any, by the digest of the text.

    A text that several rows hold is repeated as a whole if it has ``length`` bytes."""
    texts = docs.select(F.col(text_col).alias("text"), F.col("doc_id").cast("string").alias("doc")).withColumn("tk", text_key(F.col("text")))
    known = texts.groupBy("tk").agg(F.count(F.lit(1)).alias("rows"), F.min("doc").alias("pick"), F.max(F.octet_length("text")).alias("size"))
    known = stored(known.filter(F.col("size") >= length), "texts")
    copied = known.filter("rows > 1")
    total = known.agg(F.sum("size")).first()[0] or 0
    # of equal texts one row, or a few that share a doc_id too, stands for all
    other = texts.filter(F.octet_length("text") >= length).join(sized(copied.select("tk", "pick")), "tk", "left")
    sources = other.filter("pick is null or doc = pick").select(F.xxhash64("tk").alias("tid"), "tk", "text")
    keys = stored(_repeated_places(sources, total, length), "repeated-places")
    contexts = stored(_contexts(sources, keys, length), "contexts")
    spans = stored(_bucket_spans(contexts, length), "context-spans")
    places = contexts.select("c1", "c2", "tk", "at").join(spans, ["c1", "c2"]).select(
        "tk", F.struct((F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end")).alias("span"))
    by_text = places.groupBy("tk").agg(F.collect_set("span").alias("spans")).withColumn("spans", _merged(F.col("spans")))
    own = known.select("tk", "rows", "size").join(by_text, "tk", "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end")))
    return own.select("tk", F.when(F.col("rows") > 1, whole).otherwise(F.col("spans")).alias("spans")).filter("spans is not null")


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Add n_bytes, n_removed, n_spans, spans (maximal removed runs of bytes) and kept (the bytes that stay).

    A byte goes when some string of ``length`` bytes over it also starts elsewhere in
    any text, the same one included.  Null texts count as empty and texts shorter than
    ``length`` bytes keep everything; every repeated row is a text of its own, so equal
    texts of ``length`` bytes or more lose all; same-named input columns are replaced.  A very
    long text is cut into working pieces, and is held once, with its spans, by the task that
    removes them; an empty table gives an empty one."""
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "spans", "kept").withColumn("__tk", text_key(F.col(text_col)))
    found = stored(repeated_spans(docs, text_col, length).withColumnRenamed("tk", "__tk").withColumnRenamed("spans", "__spans"), "spans")
    joined = docs.join(sized(found), "__tk", "left")

    @F.pandas_udf("struct<n_removed:long,spans:array<struct<start:long,end:long>>,kept:binary>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in batches:
            rows = []
            for text, own in zip(texts, spans):
                raw = _raw(text)
                marks = np.zeros(len(raw) + 1, dtype=np.int64)
                for s in own:
                    marks[s["start"]] += 1
                    marks[s["end"]] -= 1
                gone = np.cumsum(marks[:-1]) > 0
                rows.append((int(gone.sum()), [{"start": s, "end": e} for s, e in _runs(gone, 1)], raw[~gone].tobytes()))
            yield pd.DataFrame(rows, columns=["n_removed", "spans", "kept"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    with_spans = joined.filter("__spans is not null").withColumn("__cut", cut(F.col(text_col), F.col("__spans"))).select(
        *[c for c in docs.columns if c != "__tk"], "__cut.*")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    without = joined.filter("__spans is null").select(
        *[c for c in docs.columns if c != "__tk"], F.lit(0).cast("long").alias("n_removed"), none.alias("spans"), F.encode(text, "UTF-8").alias("kept"))
    out = with_spans.unionByName(without)
    return out.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_spans": F.size("spans").cast("long")})
