"""Near duplicates of vectors by sorted projection passes.

Random hyperplanes give every vector a sketch of signs.  Each pass concatenates signs of
its own to a key, orders all vectors by their keys, and compares every vector with
a bounded window of neighbours; sketches that agree enough are verified on the vectors
themselves.  Verified pairs of all passes are joined to components.

The hyperplanes of the keys go through the mean of the vectors, so that a direction
that all share does not crowd them together.  How deep a window reaches is measured for
every vector in every pass.  Vectors whose windows do not meet their neighbours with the
wanted probability go through further passes among themselves, around a mean of their own;
what is left after these is compared with each other exactly, in blocks of fixed size.  The
links within each component are counted exactly, block by block too."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

THRESHOLD = 0.9
#: Signs in a sketch, signs in a key, neighbours compared on either side.
BITS, KEY_BITS, WINDOW = 256, 62, 16
#: Share of pairs just at the threshold that the passes shall meet.
RECALL = 0.97
#: Vectors in a block of exact counting, and rows counted by a task.
BLOCK, TASK = 2048, 20_000
#: Rounds of passes, each with twice the passes of the one before, and vectors that a mean is taken of.
ROUNDS, MEAN_ROWS = 3, 4096
#: How close to the threshold a cosine of a matrix product is taken pair by pair again.
CLOSE = 1e-9


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes needed so that a pair at the threshold is met in one of them with probability ``recall``.

    In a pass over ``n`` random vectors neighbours share about log2(n / window) leading
    signs, and a pair shares a sign with probability 1 - angle / pi."""
    same = 1 - math.acos(threshold) / math.pi
    met = same ** max(1.0, math.log2(max(n, 2) / window))
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _scaled(rows: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows, each divided by its largest component, so that no product over- or underflows."""
    v = np.vstack(rows).astype(np.float64)
    return v / np.abs(v).max(axis=1, keepdims=True)


def _planes(dim: int, bits: int, turn: int = 0) -> np.ndarray:
    return np.random.default_rng((1000 + dim, turn)).standard_normal((dim, bits))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y``."""
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``x`` link with which of ``y``, as ``cosines`` tells."""
    a, b = (v / np.sqrt((v * v).sum(axis=1, keepdims=True)) for v in (x, y))
    near = a @ b.T
    hit = near >= threshold
    i, j = np.nonzero(np.abs(near - threshold) < CLOSE)
    if len(i):
        hit[i, j] = cosines(x[i], y[j]) >= threshold
    return hit


def _means(entries: DataFrame) -> dict[int, np.ndarray]:
    """Mean direction of the vectors of each width, from the ``MEAN_ROWS`` rows with the smallest hash of their vector."""
    some = entries.select("dim", "v", "h1").orderBy("h1").limit(MEAN_ROWS).toPandas()
    out = {}
    for dim, rows in some.groupby("dim"):
        v = _scaled(rows["v"].tolist())
        out[int(dim)] = (v / np.linalg.norm(v, axis=1, keepdims=True)).mean(axis=0)
    return out


def _sketched(entries: DataFrame, passes: int, first: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """(pass, dim, key, entry, same, sketch): every entry once for each pass; ``same`` is the share of key signs that a neighbour at the threshold has in common with it."""
    means = entries.sparkSession.sparkContext.broadcast(_means(entries))  # MEAN_ROWS vectors at most
    apart = math.sqrt(2 - 2 * threshold)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)
        for b in batches:
            for dim, rows in b.groupby("dim"):
                v = _scaled(rows["v"].tolist())
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                packed = [r.tobytes() for r in np.packbits(v @ _planes(int(dim), BITS) >= 0, axis=1)]
                v -= means.value.get(int(dim), 0.0)
                angle = 2 * np.arcsin(np.minimum(1.0, apart / 2 / np.maximum(np.linalg.norm(v, axis=1), 1e-12)))
                for p in range(first, first + passes):
                    own = v @ _planes(int(dim), KEY_BITS, p + 1) >= 0
                    yield pd.DataFrame({
                        "pass": p, "dim": int(dim), "key": own @ weights, "entry": rows["entry"].to_numpy(), "same": (1 - angle / math.pi).astype(np.float32), "sketch": packed})

    return entries.select("entry", "dim", "v").mapInPandas(sketch, "pass int, dim int, key long, entry long, same float, sketch binary")


def _near(entry: np.ndarray, group: np.ndarray, sketch: np.ndarray, rank: np.ndarray, window: int, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group, at most ``window`` ranks apart, whose sketches differ in few enough signs."""
    a, b = [], []
    for step in range(1, min(window, len(entry) - 1) + 1):
        ok = (group[step:] == group[:-step]) & (rank[step:] - rank[:-step] <= window)
        i = np.flatnonzero(ok)
        i = i[np.bitwise_count(sketch[i] ^ sketch[i + step]).sum(axis=1) <= differ]
        a.append(entry[i])
        b.append(entry[i + step])
    return (np.concatenate(a), np.concatenate(b)) if a else (entry[:0], entry[:0])


def _reach(key: np.ndarray, group: np.ndarray, window: int, same: np.ndarray) -> np.ndarray:
    """For each row of an ordered range -log of the probability that the pass does not meet a neighbour at the threshold.

    Rows that share more leading signs with it than the rows at the window's ends do are
    all in the window; where the range ends first, its last row stands for the end."""
    at = np.arange(len(key))
    cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    which = np.searchsorted(cut, at, side="right") - 1
    low, high = np.maximum(at - window, cut[which]), np.minimum(at + window, np.append(cut[1:], len(key))[which] - 1)

    def shared(end: np.ndarray) -> np.ndarray:
        return np.where(end == at, 0, KEY_BITS - np.frexp((key ^ key[end]).astype(np.float64))[1])

    return -np.log1p(-np.minimum(same ** (np.maximum(shared(low), shared(high)) + 0.5), 1 - 1e-9))


def _candidates(sketched: DataFrame, window: int, differ: int) -> DataFrame:
    return _pairs(_swept(sketched, window, differ), window, differ)


def _swept(sketched: DataFrame, window: int, differ: int) -> DataFrame:
    """(kind, ...): 0 pairs within ranges, 1 rows at the ends of ranges, 2 the reach of each row's window in millionths.

    Each range of the order sweeps its own rows and leaves its first and last
    ``window`` rows behind; those few rows of all ranges are then swept across the
    boundaries between ranges."""
    fields = "kind int, a long, b long, pass int, dim int, range int, place long, size long, sketch binary"

    def border(b: pd.DataFrame, place: np.ndarray, size: int) -> pd.DataFrame:
        own = TaskContext.get().partitionId()
        return pd.DataFrame({"kind": 1, "a": b["entry"], "b": 0, "pass": b["pass"], "dim": b["dim"], "range": own, "place": place, "size": size, "sketch": b["sketch"]})

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, last, n = [], None, 0
        order: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            key, same = b["key"].to_numpy(dtype=np.int64), b["same"].to_numpy(dtype=np.float64)
            b = b[["entry", "pass", "dim", "sketch"]]
            if n < window:
                head.append(b.iloc[: window - n])
            both = b if last is None else pd.concat([last, b], ignore_index=True)
            old = 0 if last is None else len(last)
            entry, group, sketch = _rows_of(both)
            order.append((entry[old:], group[old:], key, same))
            x, y = _near(entry, group, sketch, np.arange(len(both)), window, differ)
            yield pd.DataFrame({"kind": 0, "a": np.minimum(x, y), "b": np.maximum(x, y), "pass": 0, "dim": 0, "range": 0, "place": 0, "size": 0, "sketch": None}).drop_duplicates(["a", "b"])
            n += len(b)
            last = both.iloc[-window:]
        if n:
            first = pd.concat(head)
            places = np.arange(n - len(last), n)
            tail = places >= len(first)
            yield border(first, np.arange(len(first)), n)
            yield border(last[tail], places[tail], n)
            entry, group, key, same = (np.concatenate(c) for c in zip(*order))
            reach = np.round(_reach(key, group, window, same) * 1e6).astype(np.int64)
            for lo in range(0, n, 100_000):
                part = slice(lo, lo + 100_000)
                yield pd.DataFrame({"kind": 2, "a": entry[part], "b": 0, "pass": 0, "dim": 0, "range": 0, "place": reach[part], "size": 0, "sketch": None})

    ordered = sketched.repartitionByRange("pass", "dim", "key", "entry").sortWithinPartitions("pass", "dim", "key", "entry")
    return stored(ordered.mapInPandas(sweep, fields), "sweep")


def _rows_of(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    group = b["pass"].to_numpy(dtype=np.int64) << 32 | b["dim"].to_numpy(dtype=np.int64)
    sketch = np.frombuffer(b"".join(b["sketch"]), dtype=np.uint64).reshape(len(b), -1)
    return b["entry"].to_numpy(dtype=np.int64), group, sketch


def _pairs(swept: DataFrame, window: int, differ: int) -> DataFrame:
    """Distinct pairs (a, b) that some pass puts next to each other and whose sketches are close."""

    def across(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["range", "place"])
        sizes = b.drop_duplicates("range").set_index("range")["size"]
        base = sizes.cumsum() - sizes
        entry, group, sketch = _rows_of(b.rename(columns={"a": "entry"}).drop(columns=["b"]))
        x, y = _near(entry, group, sketch, b["place"].to_numpy() + base.loc[b["range"]].to_numpy(), window, differ)
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}).drop_duplicates()

    inside = swept.filter("kind = 0").select("a", "b")
    # at most 2 * window rows of each range
    beyond = swept.filter("kind = 1").groupBy("pass", "dim").applyInPandas(across, "a long, b long")
    return inside.unionByName(beyond).distinct()


def _verified(pairs: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine, in double precision, reaches the threshold."""

    @F.pandas_udf("boolean")
    def close(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            hit, width = np.zeros(len(x), dtype=bool), x.map(len).to_numpy()
            for w in np.unique(width):  # both of a pair are of one width
                at = np.flatnonzero(width == w)
                for lo in range(0, len(at), 4096):
                    own = at[lo : lo + 4096]
                    hit[own] = cosines(np.vstack(x.iloc[own]), np.vstack(y.iloc[own])) >= threshold
            yield pd.Series(hit)

    a = entries.select(F.col("entry").alias("a"), F.col("v").alias("va"))
    b = entries.select(F.col("entry").alias("b"), F.col("v").alias("vb"))
    return pairs.join(a, "a").join(b, "b").filter(close("va", "vb")).select("a", "b")


def _found_by_passes(entries: DataFrame, passes: int, differ: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(pairs that the passes put next to each other, entries whose windows may still miss a neighbour).

    All vectors go through the first round; those whose windows together miss a neighbour
    at the threshold with more than the allowed probability go through the next one with
    twice the passes.  A pair is sought until one of its two vectors is done."""
    rows, pairs, reached, first = entries, None, None, 0
    for k in range(ROUNDS):
        swept = _swept(_sketched(rows, passes << k, first, threshold), WINDOW, differ)
        first += passes << k
        met = _pairs(swept, WINDOW, differ)
        pairs = met if pairs is None else pairs.unionByName(met)
        reach = swept.filter("kind = 2").select(F.col("a").alias("entry"), F.col("place").alias("reach"))
        reach = reach if reached is None else reach.unionByName(reached)
        reach = reach.groupBy("entry").agg(F.sum("reach").alias("reach"))
        reached = stored(reach.filter(F.col("reach") < -1e6 * math.log(1 - recall)), "crowded")
        if reached.limit(BLOCK).count() < BLOCK:
            break  # one block, compared exactly
        rows = stored(entries.join(reached.select("entry"), "entry"), "crowded-vectors")
    return pairs.distinct(), reached.select("entry")


def _crowd_links(entries: DataFrame, crowded: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join all linked crowded vectors, every block of them compared with every block.

    A pair is left out only if the links of its task join it already, so a task sends fewer
    links than it has vectors."""
    rows = stored(entries.join(crowded, "entry").select("dim", "entry", "v"), "crowded")
    sizes = rows.groupBy("dim").agg((F.floor(F.count(F.lit(1)) / BLOCK) + 1).alias("blocks"))
    tasks = sizes.agg(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2)).first()[0] or 1
    rows = rows.join(F.broadcast(sizes), "dim").withColumn("own", F.pmod(F.xxhash64("entry"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "dim", "entry", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")

    def link(b: pd.DataFrame) -> pd.DataFrame:
        i, j = b["i"].iloc[0], b["j"].iloc[0]
        v = _scaled(b["v"].tolist())
        own, entry = b["own"].to_numpy(), b["entry"].to_numpy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        label, out = np.arange(len(b)), []
        for lo in range(0, len(left), 512):
            rows = left[lo : lo + 512]
            hit = linked(v[rows], v[right], threshold)
            for r in np.flatnonzero(hit.any(axis=1)):
                to = right[hit[r]]
                to = to[label[to] != label[rows[r]]]
                if len(to):
                    joined, first = np.unique(label[to], return_index=True)
                    out.append(pd.DataFrame({"a": entry[rows[r]], "b": entry[to[first]]}))
                    label[np.isin(label, joined)] = label[rows[r]]
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)

    dealt = rows.repartition(int(min(tasks, 512)), "dim", "i", "j")
    return dealt.groupBy("dim", "i", "j").applyInPandas(link, "a long, b long")


def _link_counts(entries: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """(entry, links): rows linked with the entry, its own copies not among them, within its component.

    Components are cut into blocks; every pair of blocks of a component is counted by
    one task, and only sums leave it."""
    sizes = found.groupBy("component").agg((F.floor(F.count(F.lit(1)) / BLOCK) + 1).alias("blocks"))
    rows = found.join(sizes, "component").join(entries.select("entry", "copies", "v"), found["node"] == entries["entry"]).withColumn(
        "own", F.pmod(F.xxhash64("entry"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "component", "entry", "copies", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    n = found.count()
    tasks = max(1, math.ceil(n / TASK))
    rows = rows.withColumn("task", F.when(F.col("i") + F.col("j") > 0, F.xxhash64("component", "i", "j")).otherwise(F.pmod(F.xxhash64("component"), F.lit(tasks))))

    def count(b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), g in b.groupby(["component", "i", "j"]):
            v = _scaled(g["v"].tolist())
            own, w, entry = g["own"].to_numpy(), g["copies"].to_numpy(), g["entry"].to_numpy()
            left = np.flatnonzero(own == i)
            right = np.flatnonzero(own == j)
            sums = np.zeros(len(g), dtype=np.int64)
            for lo in range(0, len(left), 512):
                rows = left[lo : lo + 512]
                hit = linked(v[rows], v[right], threshold)
                hit &= entry[rows][:, None] != entry[right]
                sums[rows] += hit @ w[right]
                if i != j:
                    sums[right] += w[rows] @ hit
            out.append(pd.DataFrame({"entry": entry, "links": sums}))
        return pd.concat(out)

    return rows.groupBy("task").applyInPandas(count, "entry long, links long").groupBy("entry").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each row of ``vectors``.

    n_links counts the other rows linked directly, equal vectors included; component_id
    is the smallest id reachable by links, itself included; kept is id = component_id.
    Vectors that are null, empty or zero or hold null or non-finite components link with
    nothing; vectors of different widths never link.  Rows without id take part and get
    the component_id of their group (null alone) and are not kept; repeated rows are
    copies of each other.  An empty table gives an empty one."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(F.coalesce(fine, F.lit(False)), v).alias("v"))
    rows = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.unhex(F.md5(F.col("v").cast("string")))})
    copies = rows.filter("v is not null").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("v").alias("v"))
    entries = stored(copies.withColumns({"entry": F.monotonically_increasing_id(), "dim": F.size("v")}), "entries")
    # half of the allowed misses, so that vectors outside of crowds are rarely taken for crowded
    passes = passes_for(entries.count(), threshold, recall=(1 + recall) / 2)
    spread = BITS * math.acos(threshold) / math.pi
    differ = math.ceil(spread + 4.5 * math.sqrt(spread * (1 - spread / BITS)))
    pairs, left = _found_by_passes(entries, passes, differ, threshold, recall)
    links = stored(_verified(stored(pairs, "candidates"), entries, threshold).unionByName(_crowd_links(entries, left, threshold)), "verified")
    found = components(links)
    counted = _link_counts(entries, found, threshold)
    per_entry = entries.select("entry", "h1", "h2", "copies", "least").join(found.withColumnRenamed("node", "entry"), "entry", "left").withColumn(
        "component", F.coalesce("component", "entry"))
    per_entry = stored(per_entry.join(counted, "entry", "left"), "counted")
    names = per_entry.groupBy("component").agg(F.min("least").alias("component_id"))
    of_vector = per_entry.join(names, "component").select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component_id")
    out = rows.select("id", "h1", "h2", F.col("v").isNotNull().alias("fine")).join(of_vector, ["h1", "h2"], "left")
    named = F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.when(F.col("fine"), F.col("links")).otherwise(0).cast("long").alias("n_links"),
        named.alias("component_id"), F.coalesce(F.col("id") == named, F.lit(False)).alias("kept"))
