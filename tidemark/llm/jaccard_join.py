"""N-gram Jaccard join by a token-group matrix.

Documents with equal shingle sets are one entry.  Entries that share a min-hash are
compared with the smallest of them, which partitions similar entries into groups.
The join then works between groups: an inverted table of prefix tokens (the tokens of
an entry that come first when the rare ones lead; one of them must be shared by any
similar entry) names the groups that an entry may meet.  For each such group, split
into bounded parts, the union of its tokens bounds the overlap with the entry, and only
parts whose bound reaches the threshold are opened and compared entry by entry.
Entries of one group are linked already, so no pairs inside a group are made."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import among, bits_of, give_back, in_slices, sized, stored, text_key
from .components import components
from .shingles import mix, overlap, shingle_sets

#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Cells of the table of token counts that orders tokens by rarity, as a power of two: so many counters, whatever the corpus.
CELLS = 24
#: Min-hashes by which groups are formed.
MIN_HASHES = 3
#: Shingles in a part of a group, and entries that meet one copy of a part.
PART, MEETING = 20_000, 200
#: Places, as a power of two, by which texts that meet others are told apart before a shuffle: 16 MB of bits at most.
PLACES = 27
#: Shingles compared, and prefix tokens paired, by a task at once.
TASK, TOKENS = 1_500_000, 500_000

U = np.uint64


def linked(common: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return common > 0 and 100 * common >= percent * (a + b - common)


def _packed(counts: np.ndarray) -> bytes:
    """Counters as bytes: the few that are not zero with their places, or all of them compressed."""
    full = np.flatnonzero(counts)
    if 16 * len(full) < len(counts):
        return b"s" + full.astype("<u4").tobytes() + counts[full].astype("<u8").tobytes()
    return b"%d" % counts.itemsize + zlib.compress(counts.tobytes(), 1)


def _add_packed(total: np.ndarray, packed: bytes) -> None:
    if packed[:1] == b"s":
        n = (len(packed) - 1) // 12
        total[np.frombuffer(packed, "<u4", n, 1)] += np.frombuffer(packed, "<u8", n, 1 + 4 * n)
    else:
        total += np.frombuffer(zlib.decompress(packed[1:]), dtype=f"<u{packed[:1].decode()}")


def rarity(texts: DataFrame, cells: int) -> np.ndarray:
    """For each cell of token hashes how many (document, token) pairs fall into it, over all documents, as a fine logarithm.

    A token is at most as frequent as its cell is full, so the order (cell, token) puts
    rare tokens first.  Tasks send packed slices of counters, which are added up in two
    steps; 2**cells two-byte numbers come back, whatever the size of the corpus."""
    width = 1 << min(cells, 16)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << cells, dtype=np.uint32)
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in in_slices(texts):
                for s in shingle_sets(texts[lo:hi]):
                    np.add.at(total, (s >> U(64 - cells)).astype(np.int64), 1)
        rows = total.reshape(-1, width)
        full = np.flatnonzero(rows.any(axis=1))
        yield pd.DataFrame({"slice": full, "counts": [_packed(rows[k]) for k in full]})
        del total, rows
        give_back()

    def added(batch: pd.DataFrame) -> np.ndarray:
        total = np.zeros(width, dtype=np.uint64)
        for c in batch["counts"]:
            _add_packed(total, c)
        return total

    def some(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": [batch["slice"].iloc[0]], "counts": [_packed(added(batch))]})

    def levels(batch: pd.DataFrame) -> pd.DataFrame:
        fine = np.round(1000 * np.log2(1 + added(batch).astype(float))).astype(np.uint16)
        return pd.DataFrame({"slice": [batch["slice"].iloc[0]], "counts": [fine.tobytes()]})

    schema = "slice int, counts binary"
    parts = texts.mapInPandas(count, schema).withColumn("turn", F.pmod(F.spark_partition_id(), F.lit(64)))
    parts = parts.groupBy("slice", "turn").applyInPandas(some, schema).groupBy("slice").applyInPandas(levels, schema)
    out = np.zeros((1 << cells) // width * width, dtype=np.uint16).reshape(-1, width)
    for r in parts.collect():  # 2**cells numbers in all
        out[r["slice"]] = np.frombuffer(r["counts"], dtype=np.uint16)
    return out.reshape(-1)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Tokens of an ``n``-token set of which a similar set must hold one: all but those it may lack."""
    return n - -(-percent * n // 100) + 1


def near_duplicates(docs: DataFrame, text_col: str = "text", percent: int = PERCENT, cells: int = CELLS) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs`` (doc_id and a text column).

    component_id is the smallest doc_id of the documents reachable by links, itself
    included.  Texts that are null or hold no words have an empty set, link with
    nothing and keep their own doc_id.  Rows that share a doc_id are one document, so
    their links join; a row without doc_id gets the doc_id of its group, else null.
    Repeated rows stay repeated; an empty table gives an empty one.  doc_id is a whole
    number (or text of one); other columns are ignored, whatever their names.  A very long
    text is hashed in blocks, with 8 bytes for each of its shingles."""
    id_type = docs.schema["doc_id"].dataType
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col(text_col).alias("text")).withColumn("tk", text_key(F.col("text")))
    profiles = _profiles(texts, percent, cells)
    some = profiles.filter("n > 0")
    # equal sets are one entry; pick is the row whose text stands for it
    entries = stored(
        some.groupBy("k1", "k2", "n").agg(F.min("doc").alias("doc"), F.min(F.struct("doc", "tk", "row")).alias("pick"), F.first("mins").alias("mins"))
        .withColumn("entry", F.monotonically_increasing_id()), "entries")
    chosen = entries.select("entry", "n", "mins")

    found = _grouping(chosen, entries, texts, percent)
    shared = None
    # first against the largest group that shares a token, so that crowds gather, then between all groups that are left
    for hubs in (True, False):
        members = chosen.select("entry", "n").join(components(found).withColumnRenamed("node", "entry"), "entry", "left")
        members = stored(members.select("entry", "n", F.coalesce("component", "entry").alias("group")), "groups")
        if shared is None:
            # the one time that prefixes are shuffled
            rows = entries.select("entry", F.col("pick.row").alias("row")).join(members.select("entry", "group"), "entry").select("row", "group")
            with_group = some.select("row", "prefix", "n").join(rows, "row")
            shared = _shared_tokens(with_group.select("group", "prefix", "n"), percent)
        else:
            shared = _regrouped(shared, members)
        shared = stored(shared, "shared-tokens")
        pairs = _group_pairs(shared, members, percent, hubs)
        found = stored(found.unionByName(_between_groups(pairs, chosen, members, entries, texts, percent)), "links-so-far")

    own = stored(some.select("doc", "k1", "k2", "n").join(entries.select("k1", "k2", "n", "entry"), ["k1", "k2", "n"]).select("doc", "entry").distinct(), "owners")
    same = own.filter("doc is not null").groupBy("doc").agg(F.min("entry").alias("a"), F.collect_set("entry").alias("all")).filter("size(all) > 1")
    links = found.unionByName(same.select("a", F.explode("all").alias("b")))
    labels = entries.select("entry", "k1", "k2", "n", "doc").join(components(links).withColumnRenamed("node", "entry"), "entry", "left")
    labels = stored(labels.withColumn("component", F.coalesce("component", "entry")), "labels")
    names = labels.groupBy("component").agg(F.min("doc").alias("component_id"))
    of_set = labels.join(names, "component").select("k1", "k2", "n", "component_id")
    out = profiles.select("doc", "n", "k1", "k2").join(of_set, ["k1", "k2", "n"], "left")
    return out.select(
        F.col("doc").cast(id_type).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).cast(id_type).alias("component_id"))


def _profiles(texts: DataFrame, percent: int, cells: int) -> DataFrame:
    """Of each row: its number, size, 126-bit digest, prefix tokens and min-hashes of its shingle set."""
    level = texts.sparkSession.sparkContext.broadcast(rarity(texts.select("text"), cells))  # 2**cells two-byte numbers
    low = (1 << 63) - 1

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices = ((b, lo, hi) for b in batches for lo, hi in in_slices(b["text"].tolist()))
        for b, lo, hi in slices:
            out = []
            for doc, tk, s in zip(b["doc"].iloc[lo:hi], b["tk"].iloc[lo:hi], shingle_sets(b["text"].iloc[lo:hi].tolist())):
                if not len(s):
                    out.append((doc, tk, 0, 0, 0, b"", []))
                    continue
                rank = (level.value[(s >> U(64 - cells)).astype(np.int64)].astype(U) << U(48)) | ((s << U(8)) >> U(16))
                first = prefix_size(len(s), percent)
                rare = np.argpartition(rank, first - 1)[:first]
                prefix = s[rare[np.argsort(rank[rare])]]
                k1 = int(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)) & low
                k2 = int((s * U(0x2545F4914F6CDD1D)).sum(dtype=U)) & low
                mins = [int(mix(s + U(k * 0x632BE5AB)).min()) & low for k in range(MIN_HASHES)]
                out.append((doc, tk, len(s), k1, k2, prefix.tobytes(), mins))
            yield pd.DataFrame(out, columns=["doc", "tk", "n", "k1", "k2", "prefix", "mins"])
        give_back()

    # as text, ids of any size and null pass through Python unchanged
    schema = "doc string, tk binary, n long, k1 long, k2 long, prefix binary, mins array<long>"
    found = texts.select(F.col("doc").cast("string").alias("doc"), "tk", "text").mapInPandas(profile, schema)
    profiles = stored(found.withColumns({"doc": F.col("doc").cast("long"), "row": F.monotonically_increasing_id()}), "profiles")
    level.destroy()
    return profiles


def _grouping(chosen: DataFrame, entries: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between entries and the smallest entry that has one of their min-hashes."""
    mins = stored(chosen.select("entry", F.posexplode("mins").alias("which", "min")), "min-hashes")
    heads = mins.groupBy("which", "min").agg(F.min("entry").alias("part"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    queries = stored(mins.join(heads, ["which", "min"]).filter("entry <> part").select("part", "entry").distinct(), "queries")
    return _meet(queries.select("part", F.col("part").alias("entry")).distinct(), queries, chosen, entries, texts, percent)


def _regrouped(shared: DataFrame, members: DataFrame) -> DataFrame:
    """Shared tokens by the groups of now, without tokens that one group alone is left with."""
    # a group is named by one of its entries, which tells the group it is in now
    now = members.select(F.col("entry").alias("was"), "group")
    per = shared.withColumnRenamed("group", "was").join(now, "was").groupBy("token", "group").agg(F.max("rest").alias("rest"), F.min("size").alias("size"))
    per = stored(per, "regrouped")
    spread = per.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("token")
    return per.join(spread, "token", "left_semi")


def _group_pairs(shared: DataFrame, members: DataFrame, percent: int, hubs: bool) -> DataFrame:
    """(few, many): pairs of groups that may hold a link, by their shared prefix tokens; ``hubs``: only those with the largest group of a token."""
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("low"), F.max("n").alias("high"))
    side = F.struct("c", "group", "rest", "size", "low", "high")
    per = stored(shared.join(sizes, "group").select("token", side.alias("s")), "shared-by-group")
    if hubs:
        heads = per.groupBy("token").agg(F.max("s").alias("h"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("token", "h")
        both = per.join(heads, "token").filter("s.group <> h.group")
    else:
        both = per.join(per.withColumnRenamed("s", "h"), "token").filter("s.group < h.group")
    can = F.least("s.rest", "h.rest") * (100 + percent) >= (F.col("s.size") + F.col("h.size")) * percent
    fits = (F.col("s.high") * 100 >= F.col("h.low") * percent) & (F.col("h.high") * 100 >= F.col("s.low") * percent)
    few = F.least(F.struct("s.c", "s.group"), F.struct("h.c", "h.group"))
    many = F.greatest(F.struct("s.c", "s.group"), F.struct("h.c", "h.group"))
    return both.filter(can & fits).select(few["group"].alias("few"), many["group"].alias("many")).distinct()


def _between_groups(pairs: DataFrame, chosen: DataFrame, members: DataFrame, entries: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b): the entries of ``few`` against the parts of ``many``, at least one for each entry and part that hold any."""
    # a group is cut into parts of about PART shingles, each with a token union of its own
    parts = members.groupBy("group").agg((F.floor(F.sum("n") / PART) + 1).alias("parts"))
    parted = members.join(parts, "group").select("entry", "group", F.xxhash64("group", F.pmod(F.xxhash64("entry"), "parts")).alias("part"))
    parted = stored(parted, "parts")
    queries = stored(
        pairs.join(members.select("entry", F.col("group").alias("few")), "few").select("entry", "many")
        .join(parted.select(F.col("group").alias("many"), "part").distinct(), "many").select("part", "entry").distinct(), "queries")
    holders = parted.join(queries.select("part").distinct(), "part").select("part", "entry")
    return _meet(holders, queries, chosen, entries, texts, percent)


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap that links sets of ``a`` and ``b`` tokens."""
    return -(-percent * (a + b) // (100 + percent))


def _planes(x: np.ndarray) -> bytes:
    """Numbers as bytes, the lowest byte of all first, so that the shuffle's compression sees the bytes that hardly differ side by side."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _from_planes(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _shared_tokens(prefixes: DataFrame, percent: int) -> DataFrame:
    """(token, group, rest, size) of prefix tokens that several groups share where a link is possible; ``prefixes`` has group, prefix, n.

    Tokens travel as packed arrays, by ranges of the token.  A group sends a token once
    for each task, however many of its entries hold it, with the most tokens that any of
    them has from there on (rest) and the smallest of their sizes.  At the first token
    that two sets share, their overlap is at most what the shorter rest holds; a token
    where that cannot suffice for any partner is left out."""
    total = prefixes.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, math.ceil(total / 4 / TOKENS))

    def once(t: np.ndarray, g: np.ndarray, rest: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((g, t))
        t, g, rest, size = t[order], g[order], rest[order], size[order]
        new = np.ones(len(t), dtype=bool)
        new[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])
        at = np.flatnonzero(new)
        return t[at], g[at], np.maximum.reduceat(rest, at), np.minimum.reduceat(size, at)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0

        def out() -> pd.DataFrame:
            t, g, rest, size = once(*(np.concatenate(c) for c in zip(*held)))
            where = ((t >> U(40)).astype(np.int64) * ranges) >> 24
            cut = np.searchsorted(where, np.arange(ranges + 1))
            full = [(k, slice(cut[k], cut[k + 1])) for k in range(ranges) if cut[k + 1] > cut[k]]
            width = 2 if size.max() < 1 << 16 and rest.max() < 1 << 16 else 4
            return pd.DataFrame({
                "range": [k for k, _ in full], "width": width, "tokens": [_planes(t[c]) for _, c in full], "groups": [_planes(g[c]) for _, c in full],
                "rests": [_planes(rest[c].astype(f"<u{width}")) for _, c in full], "sizes": [_planes(size[c].astype(f"<u{width}")) for _, c in full],
            })

        for b in batches:
            for g, raw, n in zip(b["group"], b["prefix"], b["n"]):
                t = np.frombuffer(raw, dtype=U)
                held.append((t, np.full(len(t), g, dtype=np.int64), n - np.arange(len(t)), np.full(len(t), n, dtype=np.int64)))
                count += len(t)
                if count >= TOKENS:
                    yield out()
                    held, count = [], 0
        if held:
            yield out()
        held = []
        give_back()

    def shared(batch: pd.DataFrame) -> pd.DataFrame:
        kinds = [f"<u{w}" for w in batch["width"]]
        t, g, rest, size = once(
            np.concatenate([_from_planes(x, U) for x in batch["tokens"]]),
            np.concatenate([_from_planes(x, np.int64) for x in batch["groups"]]),
            np.concatenate([_from_planes(x, k) for x, k in zip(batch["rests"], kinds)]).astype(np.int64),
            np.concatenate([_from_planes(x, k) for x, k in zip(batch["sizes"], kinds)]).astype(np.int64))
        for _ in range(2):  # again, as the smallest partner may have gone
            if not len(t):
                break
            first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            runs = np.diff(np.concatenate((first, [len(t)])))
            least = np.maximum(np.repeat(np.minimum.reduceat(size, first), runs), -(-percent * size // 100))
            stay = (rest >= needed(size, least, percent)) & np.repeat(runs > 1, runs)
            t, g, rest, size = t[stay], g[stay], rest[stay], size[stay]
        return pd.DataFrame({"token": t.view(np.int64), "group": g, "rest": rest, "size": size})

    fields = "range int, width int, tokens binary, groups binary, rests binary, sizes binary"
    sent = prefixes.select("group", "prefix", "n").mapInPandas(send, fields)
    return sent.groupBy("range").applyInPandas(shared, "token long, group long, rest long, size long")


def _meet(holders: DataFrame, queries: DataFrame, chosen: DataFrame, entries: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b): for each (part, entry) of ``queries`` one holder of the part that the entry links with, if any.

    A part that many entries want is copied, so that at most about MEETING of them meet
    one copy; copies are dealt to tasks of about TASK shingles."""
    wants = queries.groupBy("part").agg((F.floor(F.count(F.lit(1)) / MEETING) + 1).alias("copies"))
    holding = holders.join(wants, "part").select("part", "entry", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), F.lit(True).alias("holds"))
    asking = queries.join(wants, "part").select("part", "entry", F.pmod(F.xxhash64("entry"), "copies").alias("copy"), F.lit(False).alias("holds"))
    rows = holding.unionByName(asking).join(chosen.select("entry", "n"), "entry").join(entries.select("entry", "pick"), "entry")
    rows = stored(rows, "meetings")
    total = rows.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, math.ceil(total / TASK))
    dealt = rows.withColumn("task", F.pmod(F.xxhash64("part", "copy"), F.lit(tasks)))
    few = sized(dealt)
    if few is dealt:  # most texts that meet no other are left out before the shuffle
        place = lambda tk: F.pmod(F.xxhash64(tk), F.lit(1 << PLACES))
        texts = among(texts, place("tk"), stored(bits_of(rows.select(place("pick.tk").alias("place"))), "met-texts"))
    dealt = few
    with_text = texts.join(dealt, F.col("tk").eqNullSafe(F.col("pick.tk")) & F.col("doc").eqNullSafe(F.col("pick.doc"))).select(
        "task", "part", "copy", "holds", "entry", "text")

    def open_parts(batch: pd.DataFrame) -> pd.DataFrame:
        once = batch.drop_duplicates("entry")
        sets = dict(zip(once["entry"], shingle_sets(once["text"].tolist())))
        found = []
        for _, rows in batch.groupby(["part", "copy"]):
            held = sorted({e for e, h in zip(rows["entry"], rows["holds"]) if h})
            union = sets[held[0]] if len(held) == 1 else np.unique(np.concatenate([sets[e] for e in held]))
            for q in {e for e, h in zip(rows["entry"], rows["holds"]) if not h}:
                s = sets[q]
                if 100 * overlap(s, union) < percent * len(s):
                    continue  # no member can reach the threshold
                for e in held:
                    t = sets[e]
                    if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)) and linked(overlap(s, t), len(s), len(t), percent):
                        found.append((min(q, e), max(q, e)))
                        break
        del sets
        give_back()
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return stored(with_text.groupBy("task").applyInPandas(open_parts, "a long, b long").distinct(), "links-found")
