"""Approximate top-k by an inverted file of product codes.

Vectors are unit-scaled and belong to the k-means cell of the nearest centroid; each is stored
as a short product code.  A query visits the cells whose centroids are nearest to it,
scores their codes by table look-ups, and only the best few are scored exactly from the
vectors themselves.  Centroids and code books are fitted on a bounded sample; every
row is in the index.  How many cells a query visits follows from a sample of queries that
are searched exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.search import SCORE_DECIMALS, knn_exact, matrix, row_cosines
from tidemark.session import materialise

#: Rows that centroids and code books are fitted on, and most cells.
SAMPLE_ROWS, MOST_CELLS = 20_000, 4096
#: Dimensions a code byte stands for, and values of a byte.
SUB, VALUES = 4, 256
#: Rows of a cell that one task scores; a larger cell is split.
PART_ROWS = 65_536
#: Queries searched exactly to find how many cells must be visited, and the share of their hits that those must hold.
PROBE_SAMPLE, PROBE_RECALL = 100, 0.97
#: Codes of a query that are followed by an exact score, as a multiple of k.
RESCORED = 30


def _unit(vectors, dim: int) -> np.ndarray:
    """Rows of length one; null, empty and zero vectors are zero."""
    out = np.zeros((len(vectors), dim), dtype=np.float32)
    for i, v in enumerate(vectors):
        if v is not None and len(v):
            if len(v) != dim:
                raise ValueError(f"vector of width {len(v)} among vectors of width {dim}")
            out[i] = v
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-30)


def _k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator, unit: bool = False) -> np.ndarray:
    """Centroids of ``x`` (Lloyd's algorithm from random rows; a centroid without rows stays)."""
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _nearest(x, c)
        sums, n = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        if unit:
            c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-30)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    for lo in range(0, len(x), 4096):
        out[lo : lo + 4096] = np.argmax(x[lo : lo + 4096] @ c.T - 0.5 * (c * c).sum(axis=1), axis=1)
    return out


@dataclass
class Books:
    """What is fitted: centroids (cells x dim) and code books (parts x values x SUB)."""

    centroids: np.ndarray
    books: np.ndarray

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def _parts(self, x: np.ndarray) -> np.ndarray:
        width = self.books.shape[0] * SUB
        return np.pad(x, ((0, 0), (0, width - x.shape[1]))).reshape(len(x), -1, SUB)

    def codes(self, x: np.ndarray) -> np.ndarray:
        parts = self._parts(x)
        return np.stack([_nearest(parts[:, j], self.books[j]) for j in range(len(self.books))], axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each query the dot product of its parts with each value of the books."""
        return np.einsum("qjs,jvs->qjv", self._parts(q), self.books)

    def cells(self, q: np.ndarray) -> np.ndarray:
        """Cells of each query, nearest first."""
        return np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")


@dataclass
class Index:
    """A fitted inverted file: its books, the stored (cell, part, id, code) rows and the vectors they stand for."""

    books: Books
    codes: DataFrame
    vectors: DataFrame
    parts: dict[int, int]
    rows: int


def fit(corpus: DataFrame, id_col: str, vec_col: str, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> tuple[Books, int]:
    """Centroids and code books from the ``sample_rows`` rows with the smallest hash of their id, and the number of rows."""
    n = corpus.count()
    cells = cells or max(1, min(MOST_CELLS, round(math.sqrt(n))))
    sample = corpus.select(id_col, vec_col).filter(F.size(vec_col) > 0).orderBy(F.xxhash64(id_col), id_col).limit(sample_rows).collect()
    dim = max((len(r[vec_col]) for r in sample), default=1)
    x = _unit([r[vec_col] for r in sample], dim) if sample else np.zeros((1, dim), dtype=np.float32)
    rng = np.random.default_rng(seed)
    centroids = _k_means(x, cells, 12, rng, unit=True)
    padded = np.pad(x, ((0, 0), (0, -dim % SUB))).reshape(len(x), -1, SUB)
    books = [_k_means(padded[:, j], VALUES, 8, rng) for j in range(padded.shape[1])]
    return Books(centroids, np.stack(books)), n


def build(corpus: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cells: int | None = None, sample_rows: int = SAMPLE_ROWS) -> Index:
    """The index of every row of ``corpus``; null, empty and zero vectors are rows of it too, with score 0."""
    books, n = fit(corpus, id_col, vec_col, cells, sample_rows)
    held = corpus.sparkSession.sparkContext.broadcast(books)  # bounded: MOST_CELLS centroids and a few code books

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _unit(b[vec_col].tolist(), held.value.dim)
            yield pd.DataFrame({"cell": _nearest(x, held.value.centroids), id_col: b[id_col], "code": [c.tobytes() for c in held.value.codes(x)]})

    schema = T.StructType([T.StructField("cell", T.LongType()), corpus.schema[id_col], T.StructField("code", T.BinaryType())])
    placed = materialise(corpus.select(id_col, vec_col).mapInPandas(coded, schema), "ivf-placed")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # one row a cell
    parts = {c: -(-s // PART_ROWS) for c, s in sizes.items()}
    many = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in parts.items() if kv[1] > 1 for v in kv]), "cell"), F.lit(1)) if max(parts.values(), default=1) > 1 else F.lit(1)
    stored = materialise(placed.withColumn("part", F.pmod(F.xxhash64(id_col), many).cast("long")).repartition("cell", "part").sortWithinPartitions("cell", "part"), "ivf-codes")
    return Index(books, stored, corpus.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vector")), parts, n)


def visited_cells(index: Index, queries: DataFrame, k: int, recall: float = PROBE_RECALL) -> int:
    """How many cells a query visits so that a sample of ``queries`` (qid, qv) finds the share ``recall`` of its exact hits there."""
    some = materialise(queries.orderBy(F.xxhash64("qid"), "qid").limit(PROBE_SAMPLE), "ivf-sample")
    hits = knn_exact(some, index.vectors, k, "qid", "qv", "id", "vector").select("qid", "id")
    id_col = next(c for c in index.codes.columns if c not in ("cell", "part", "code"))
    rows = hits.join(index.codes.select(F.col(id_col).alias("id"), "cell"), "id").join(some, "qid").select("cell", "qv").collect()
    if not rows:
        return 1
    order = index.books.cells(_unit([r["qv"] for r in rows], index.books.dim))
    place = np.argmax(order == np.array([r["cell"] for r in rows])[:, None], axis=1)
    return int(np.quantile(place, recall, method="higher")) + 1


def knn_ivf(
    queries: DataFrame, index: Index, k: int, qid_col: str = "qid", qvec_col: str = "embedding", visits: int | None = None, rescored: int = RESCORED,
) -> DataFrame:
    """(qid, rank, score, id, scanned, scored) approximate top-k of each query, ranked like ``knn_exact``.

    ``scanned`` and ``scored``: how many rows' codes the query read, and how many rows it
    scored exactly.  Queries and the parts of cells they visit meet by key; a task
    scores the codes of one part for its queries and passes on the best k * ``rescored`` of
    each.  A query whose cells hold fewer than k rows gets those.  No queries or no rows
    give no hits."""
    books = index.books
    q = materialise(queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv")), "ivf-queries")
    visits = visits or visited_cells(index, q, k)
    id_col = next(c for c in index.codes.columns if c not in ("cell", "part", "code"))
    held = q.sparkSession.sparkContext.broadcast((books, index.parts))
    best = k * rescored

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books, parts = held.value
        for b in batches:
            cells = books.cells(_unit(b["qv"].tolist(), books.dim))[:, :visits]
            rows = [(i, c, p) for i, own in enumerate(cells.tolist()) for c in own for p in range(parts.get(c, 0))]
            at = [r[0] for r in rows]
            yield pd.DataFrame({"qid": b["qid"].to_numpy()[at], "qv": b["qv"].to_numpy()[at], "cell": [r[1] for r in rows], "part": [r[2] for r in rows]})

    def scan(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        books = held.value[0]
        out = []
        if len(asked) and len(rows):
            codes = np.frombuffer(b"".join(rows["code"]), dtype=np.uint8).reshape(len(rows), -1).astype(np.int64)
            ids = rows[id_col].to_numpy()
            for lo in range(0, len(asked), 64):
                own = asked.iloc[lo : lo + 64]
                tables = books.tables(_unit(own["qv"].tolist(), books.dim))
                for qid, t in zip(own["qid"], tables):
                    near = t[np.arange(codes.shape[1]), codes].sum(axis=1)
                    top = np.arange(len(near))
                    if len(near) > best:  # of rows with equal codes those with the smallest ids
                        top = np.flatnonzero(near >= np.partition(near, len(near) - best)[len(near) - best])
                        top = top[np.lexsort((ids[top], -near[top]))[:best]]
                    first = np.zeros(len(top), dtype=np.int64)
                    first[:1] = len(near)  # how many codes were read, told once
                    out.append(pd.DataFrame({"qid": qid, "id": ids[top], "near": near[top].astype(float), "read": first}))
        return pd.concat(out) if out else pd.DataFrame({"qid": [], "id": [], "near": [], "read": []})

    kinds = q.schema["qid"].dataType, index.codes.schema[id_col].dataType
    probe = T.StructType([T.StructField("qid", kinds[0]), q.schema["qv"], T.StructField("cell", T.LongType()), T.StructField("part", T.LongType())])
    found = T.StructType([T.StructField("qid", kinds[0]), T.StructField("id", kinds[1]), T.StructField("near", T.DoubleType()), T.StructField("read", T.LongType())])
    asked = q.mapInPandas(visit, probe)
    near = materialise(asked.groupBy("cell", "part").cogroup(index.codes.groupBy("cell", "part")).applyInPandas(scan, found), "ivf-near")
    read = near.groupBy("qid").agg(F.sum("read").alias("scanned"))
    few = near.withColumn("turn", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("near").desc(), "id"))).filter(F.col("turn") <= best)

    dim = books.dim

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(row_cosines(matrix(a, dim), matrix(b, dim)))

    scored = few.select("qid", "id").join(index.vectors, "id").join(q, "qid").select("qid", "id", cosine(F.col("qv"), F.col("vector")).alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "id")))
    of_query = scored.groupBy("qid").agg(F.count(F.lit(1)).alias("scored"))
    top = ranked.filter(F.col("rank") <= k).join(of_query, "qid").join(read, "qid")
    return top.select("qid", "rank", F.round("score", SCORE_DECIMALS).alias("score"), "id", "scanned", "scored")


def recall_report(approx: DataFrame, exact: DataFrame, rows: int) -> DataFrame:
    """qid, recall (share of the exact hits found) and the shares of ``rows`` whose codes were read and that were scored exactly."""
    seen = approx.groupBy(F.col("qid").alias("__q")).agg(F.max("scanned").alias("scanned"), F.max("scored").alias("scored"), F.collect_set("id").alias("ids"))
    hit = exact.join(seen, F.col("qid") == F.col("__q"), "left")
    found = F.coalesce(F.array_contains("ids", F.col("id")), F.lit(False))
    return hit.groupBy("qid").agg(
        F.avg(found.cast("int")).alias("recall"), (F.max(F.coalesce("scanned", F.lit(0))) / rows).alias("share_read"),
        (F.max(F.coalesce("scored", F.lit(0))) / rows).alias("share_scored"))
