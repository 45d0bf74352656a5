"""Vector search, query expansion join, reranking, many-query scenarios.

Exact top-k (``knn_exact``) never forms query x corpus pairs as rows.  Queries and corpus
are dealt into blocks of bounded size by a hash of their ids, and every pair of blocks
meets in one group: a task scores it with matrix products and passes on the best k of each
query, which a window merges.  Neither side passes through the driver, and a task
holds two blocks whatever the sizes.  ``knn_lsh`` and ``operators.ann`` are the approximate
alternatives.
"""



import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import vectors as V
from tidemark.session import materialise

SCORE_DECIMALS = 6
MAX_SCORE_CELLS = 4_000_000  # scores held at once (rows x queries)
MAX_SCORE_VALUES = 4_000_000  # vector values that are scored pair by pair at once
#: Queries and corpus rows in a block; a task of the exact search holds one of each.
QUERY_BLOCK, CORPUS_BLOCK = 16_384, 16_384
#: Groups of rows, as a multiple of k, whose best scores tell how low the k-th best of all can be.
GROUPS = 32
#: Rows for each query, as a multiple of k, that single precision may leave to be scored pair by pair.
LEFT = 8


def matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows of one width; null and empty ones are zero, any other width is an error."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        if v is not None and len(v):
            if len(v) != width:
                raise ValueError(f"vector of width {len(v)} among vectors of width {width}")
            out[i] = v
    return out


def _ratios(dots: np.ndarray, den: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(den > 0, dots / np.sqrt(den), 0.0)


def row_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; 0 where one is zero."""
    return _ratios(np.einsum("ij,ij->i", a, b), np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def _block(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as :func:`matrix` has them, in the type they come in and without a copy where all are there."""
    own = vectors.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False)
    other = sizes[(sizes > 0) & (sizes != width)]
    if len(other):
        raise ValueError(f"vector of width {other[0]} among vectors of width {width}")
    values = own.flatten()
    if values.type not in (pa.float32(), pa.float64()):
        values = values.cast(pa.float64())
    held = values.to_numpy(zero_copy_only=False).reshape(int((sizes > 0).sum()), width)
    if len(held) == len(sizes):
        return held
    out = np.zeros((len(sizes), width), dtype=held.dtype)
    out[sizes > 0] = held
    return out


def _dots(A: np.ndarray, a, B: np.ndarray, b) -> np.ndarray:
    """Dot products of the rows ``a`` of ``A`` with the rows ``b`` of ``B``, each summed alike whatever the others are."""
    out, step = np.empty(len(a)), max(1, MAX_SCORE_VALUES // max(1, A.shape[1]))
    for lo in range(0, len(a), step):
        some = slice(lo, lo + step)
        out[some] = np.einsum("ij,ij->i", A[a[some]].astype(np.float64), B[b[some]].astype(np.float64))
    return out


def _squares(X: np.ndarray) -> np.ndarray:
    every = np.arange(len(X))
    return _dots(X, every, X, every)


def _few_of_each(X: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Rows without those that have ``k`` equal rows before them in ``order``, which can be no query's hits."""
    bits = np.ascontiguousarray(X).view(np.uint8).reshape(len(X), -1)
    if not bits.shape[1]:
        return np.sort(np.argsort(order)[:k])
    words = X.view(np.uint32 if X.dtype == np.float32 else np.uint64)
    odd = np.random.default_rng(7).integers(1, 2**63, X.shape[1], dtype=np.uint64) | np.uint64(1)
    digest = np.zeros(len(X), dtype=np.uint64)
    for j in range(X.shape[1]):
        digest += words[:, j] * odd[j]
    by = np.lexsort((order, digest))
    first = np.searchsorted(digest[by], digest[by])
    late = np.arange(len(by)) - first >= k
    keep = np.ones(len(X), dtype=bool)
    for at in np.unique(first[late]):  # a digest that more than k rows share
        run = by[at : np.searchsorted(first, at, side="right")]
        keep[run[k:]] = (bits[run] != bits[run[0]]).any()
    return np.flatnonzero(keep)


def _units(X: np.ndarray, xx: np.ndarray) -> np.ndarray:
    """Rows of length one; those without a length are zero."""
    scale = np.zeros(len(X))
    np.divide(1.0, np.sqrt(xx), out=scale, where=xx > 0)
    out = X.astype(np.float32) * scale.astype(np.float32)[:, None]
    out[~(xx > 0)] = 0
    return out


def _candidates(rough: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of all scores of a queries x rows matrix that are less than ``slack`` below the ``k`` best of their query.

    The k-th of the best scores of separate groups of rows is at most the k-th best score."""
    n = rough.shape[1]
    if n <= k:
        return tuple(x.ravel() for x in np.indices(rough.shape))
    groups = min(n, GROUPS * k)
    tops = rough[:, : n - n % groups].reshape(len(rough), -1, groups).max(axis=1)
    least = np.partition(tops, groups - k, axis=1)[:, groups - k]
    return np.divmod(np.flatnonzero(rough >= (least - slack)[:, None]), n)


def _best(Q: np.ndarray, C: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the ``k`` best rows of each query; of equal scores those first in ``order`` (the rank of each row's id).

    Matrix products find the rows that can be among them; their scores are then taken
    pair by pair, so that a pair scores the same in whatever block it meets.  The products
    are of unit vectors in single precision, and the slack is more than their error.  Double
    precision is for what that leaves too much of, and for squares that may leave its range."""
    kept = _few_of_each(C, order, k)
    if len(kept) < len(C):
        C, order = C[kept], order[kept]
    qq, cc = _squares(Q), _squares(C)
    plain = all(np.all((x == 0) | np.isnan(x) | ((x > 1e-60) & (x < 1e60))) for x in (qq, cc))
    q, c = (_units(Q, qq), _units(C, cc)) if plain else (None, None)
    step = max(1, min(len(Q), MAX_SCORE_CELLS // len(C)))
    room = np.empty((step, len(C)), dtype=np.float32)
    found = []
    for lo in range(0, len(Q), step):
        own = np.arange(lo, min(lo + step, len(Q)))
        if plain:
            query, row = _candidates(np.matmul(q[own], c.T, out=room[: len(own)]), k, (Q.shape[1] + 16) * 2.0**-23)
        if not plain or len(query) > LEFT * max(k, 16) * len(own):
            rough = _ratios(Q[own].astype(np.float64) @ C.astype(np.float64).T, qq[own, None] * cc[None, :])
            query, row = _candidates(np.nan_to_num(rough, nan=np.inf), k, (Q.shape[1] + 16) * 2.0**-50)
        query = own[query]
        score = _ratios(_dots(Q, query, C, row), qq[query] * cc[row])
        by = np.lexsort((order[row], -score, query))
        query, row, score = query[by], row[by], score[by]
        top = np.arange(len(query)) - np.searchsorted(query, query) < k
        found.append((query[top], kept[row[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _blocks(df: DataFrame, key: str, size: int) -> int:
    return max(1, math.ceil(df.select(key).count() / size))


def knn_exact(queries: DataFrame, corpus: DataFrame, k: int, qid_col: str = "qid", qvec_col: str = "embedding",
              id_col: str = "chunk_id", vec_col: str = "embedding", payload: list[str] | None = None,
              query_block: int = QUERY_BLOCK, corpus_block: int = CORPUS_BLOCK) -> DataFrame:
    """Top-k corpus rows per query by cosine score, ties broken by ``id_col`` (null last).

    Output: ``qid, rank, score, id_col, *payload``.  ``rank`` is 1-based.  Every row goes
    once to each block of the other side, so the shuffle holds
    rows x query blocks + queries x corpus blocks vectors.
    """
    payload = [c for c in (payload or []) if c not in (id_col, vec_col)]
    q = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv"))
    c = corpus.select(F.col(id_col).alias("cid"), F.col(vec_col).alias("cv"))
    q_blocks, c_blocks = _blocks(q, "qid", query_block), _blocks(c, "cid", corpus_block)

    def dealt(df: DataFrame, key: str, own: str, blocks: int, other: str, others: int) -> DataFrame:
        """Each row in its own block, once for each block of the other side."""
        df = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(blocks)))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))

    def meet(asked: pa.Table, rows: pa.Table) -> pa.Table:
        query = row = np.empty(0, dtype=np.int64)
        score = np.empty(0)
        if len(asked) and len(rows):
            width = max(pc.max(pc.list_value_length(side)).as_py() or 0 for side in (asked["qv"], rows["cv"]))
            order = np.empty(len(rows), dtype=np.int64)
            order[pc.sort_indices(rows["cid"], null_placement="at_end").to_numpy()] = np.arange(len(rows))
            query, row, score = _best(_block(asked["qv"], width), _block(rows["cv"], width), order, k)
        return pa.table({"qid": asked["qid"].take(pa.array(query)), "score": score, "cid": rows["cid"].take(pa.array(row))})

    schema = T.StructType([T.StructField("qid", q.schema["qid"].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("cid", c.schema["cid"].dataType)])
    keys = ["_qb", "_cb"]
    cands = dealt(q, "qid", "_qb", q_blocks, "_cb", c_blocks).groupBy(*keys).cogroup(
        dealt(c, "cid", "_cb", c_blocks, "_qb", q_blocks).groupBy(*keys)).applyInArrow(meet, schema)
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("cid").asc_nulls_last())
    ranked = cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    ranked = ranked.select("qid", "rank", F.round("score", SCORE_DECIMALS).alias("score"), F.col("cid").alias(id_col))
    if payload:
        ranked = ranked.join(corpus.select(id_col, *payload), id_col)
    return ranked.select("qid", "rank", "score", id_col, *payload)


# ---------------------------------------------------------------- approximate search
PROBE_SAMPLE = 100  # queries searched exactly to measure how many buckets must be probed
MAX_PROBED_SHARE = 0.1  # share of the corpus in the probed buckets beyond which exact search costs less


def _hyperplanes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.standard_normal((tables, bits, dim))


def lsh_keys(vec_col: str, dim: int, bits: int = 8, tables: int = 4, seed: int = 7):
    """Sign-random-projection bucket per table: ``array<int>`` (entry t = bucket in
    table t).  One matrix product per Arrow batch."""
    H = _hyperplanes(dim, bits, tables, seed).reshape(tables * bits, dim)
    weights = (1 << np.arange(bits)).astype(np.int64)

    @F.pandas_udf("array<int>")
    def _keys(s: pd.Series) -> pd.Series:
        if len(s) == 0:
            return pd.Series([], dtype=object)
        X = np.vstack([np.asarray(v, dtype=np.float64) for v in s])
        signs = (X @ H.T >= 0).reshape(len(s), tables, bits).astype(np.int64)
        codes = (signs * weights).sum(axis=2).astype(np.int32)
        return pd.Series(list(codes))

    return _keys(F.col(vec_col))


def _cosine_rows(a: pd.Series, b: pd.Series) -> pd.Series:
    """Row-wise cosine on Arrow batches (same formula as the exact search)."""
    if len(a) == 0:
        return pd.Series([], dtype="float64")
    width = max(len(v) for v in a)
    return pd.Series(row_cosines(matrix(a, width), matrix(b, width)))


def _probe_radius(q: DataFrame, corpus: DataFrame, k: int, dim: int, bits: int, tables: int, seed: int,
                  id_col: str, vec_col: str, recall: float) -> int:
    """Signs in which a probed bucket may differ from the query's own, so that a sample of
    queries finds the share ``recall`` of its exact top-k."""
    sample = q.orderBy(F.xxhash64("qid"), "qid").limit(PROBE_SAMPLE)
    hits = knn_exact(sample, corpus, k, "qid", "qv", id_col, vec_col).select("qid", id_col)
    near = hits.join(corpus.select(id_col, F.col(vec_col).alias("_cv")), id_col).join(sample, "qid")
    keys = near.select(lsh_keys("qv", dim, bits, tables, seed).alias("a"), lsh_keys("_cv", dim, bits, tables, seed).alias("b")).collect()
    if not keys:
        return 0
    apart = np.array([[x ^ y for x, y in zip(r["a"], r["b"])] for r in keys], dtype=np.int64)
    differ = np.bitwise_count(apart).min(axis=1)
    return next(d for d in range(bits + 1) if (differ <= d).mean() >= recall)


def knn_lsh(queries: DataFrame, corpus: DataFrame, k: int, dim: int, qid_col: str = "qid",
            qvec_col: str = "embedding", id_col: str = "chunk_id", vec_col: str = "embedding",
            payload: list[str] | None = None, bits: int | None = None, tables: int = 12, seed: int = 7,
            recall: float = 0.95) -> DataFrame:
    """Approximate top-k: candidates share a sign-projection bucket with the query
    in at least one table; candidates are re-scored exactly and ranked like
    :func:`knn_exact`.  The join is on ``(table, bucket)``; the query side is the
    small side, so a crowded corpus bucket stays spread over the corpus tasks.

    ``bits`` follows the corpus by default, so that a bucket holds about ``16 k``
    vectors at any size.  Buckets that differ from the query's in a few signs are probed
    too, as many as a sample of queries needs to find the share ``recall`` of its exact
    hits; where those buckets hold too much of the corpus, all queries are searched
    exactly.  Queries whose buckets hold fewer than ``k`` vectors are
    searched exactly, so every query gets ``k`` hits where the corpus has them."""
    n = corpus.count()
    if bits is None:
        bits = max(1, round(math.log2(max(2.0, n / (16 * k)))))
    payload = [c for c in (payload or []) if c not in (id_col, vec_col)]
    q = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv"))
    radius = _probe_radius(q, corpus, k, dim, bits, tables, seed, id_col, vec_col, recall)
    probes = sum(math.comb(bits, d) for d in range(radius + 1))
    if radius and tables * probes > MAX_PROBED_SHARE * 2 ** bits:
        return knn_exact(q, corpus, k, "qid", "qv", id_col, vec_col, payload)
    masks = [sum(1 << i for i in c) for d in range(radius + 1) for c in combinations(range(bits), d)]
    q = q.withColumn("_k", lsh_keys("qv", dim, bits, tables, seed)).select(
        "qid", "qv", F.posexplode("_k").alias("t", "_b"))
    q = q.select("qid", "qv", "t", F.explode(F.array(*[F.col("_b").bitwiseXOR(F.lit(m)) for m in masks])).alias("b"))
    c = corpus.select(id_col, vec_col, *payload)
    c = c.withColumn("_k", lsh_keys(vec_col, dim, bits, tables, seed)).select(
        id_col, vec_col, *payload, F.posexplode("_k").alias("t", "b"))
    # score right after the bucket join (narrow), so only (qid, id, score, payload)
    # travel through the de-duplication shuffle, never the vectors
    pairs = c.join(q, ["t", "b"]).select("qid", id_col, *payload, F.pandas_udf(_cosine_rows, "double")(F.col("qv"), F.col(vec_col)).alias("score"))
    scored = pairs.dropDuplicates(["qid", id_col])
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col(id_col).asc())
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    found = materialise(ranked.select("qid", "rank", F.round("score", SCORE_DECIMALS).alias("score"), id_col, *payload), "lsh-hits")
    full = found.groupBy("qid").count().filter(F.col("count") >= min(k, n)).select("qid")
    short = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv")).join(full, "qid", "left_anti")
    if not short.limit(1).count():
        return found
    rest = knn_exact(short, corpus, k, "qid", "qv", id_col, vec_col, payload)
    return found.join(full, "qid", "left_semi").unionByName(rest.select(*found.columns))


def recall_vs_exact(approx: DataFrame, exact: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """Share of exact hits that the approximate search also returned, per query and overall."""
    e = exact.select("qid", id_col, F.lit(1).alias("_e"))
    a = approx.select("qid", id_col, F.lit(1).alias("_a"))
    j = e.join(a, ["qid", id_col], "left")
    return j.groupBy("qid").agg((F.count("_a") / F.count("*")).alias("recall"))


# ---------------------------------------------------------------- expansion, rerank
def expanded_queries(questions: DataFrame, expansions: DataFrame | None, qid_col: str = "qid",
                     text_col: str = "question") -> DataFrame:
    """Adds ``search_text``: the trimmed expansion when non-empty, else the question."""
    if expansions is None:
        return questions.withColumn("search_text", F.col(text_col))
    e = expansions.select(F.col("qid").alias("_qid"), F.col("expanded"))
    j = questions.join(e, F.col(qid_col) == F.col("_qid"), "left").drop("_qid")
    return j.withColumn("search_text", F.coalesce(F.nullif(F.trim(F.col("expanded")), F.lit("")), F.col(text_col)))


def overlap_score(query: str | F.Column, text: str | F.Column) -> F.Column:
    """Default rerank score: number of distinct shared terms; empty text -> -inf."""
    qc = F.col(query) if isinstance(query, str) else query
    tc = F.col(text) if isinstance(text, str) else text
    shared = F.size(F.array_intersect(F.array_distinct(V.terms(qc)), F.array_distinct(V.terms(tc)))).cast("double")
    return F.when(F.coalesce(tc, F.lit("")) == "", F.lit(float("-inf"))).otherwise(shared)


def rerank(hits: DataFrame, query_col: str = "rerank_query", text_col: str = "text", top_k: int | None = None,
           group_cols: list[str] | None = None, score_fn=None) -> DataFrame:
    """Re-order each query's hits by a scorer (default :func:`overlap_score`),
    stable on the retrieval rank; ``rank`` becomes the new position, the old one
    stays in ``retrieval_rank``; keep ``top_k``."""
    group_cols = group_cols or ["qid"]
    score_fn = score_fn or overlap_score
    scored = hits.withColumn("rerank_score", score_fn(F.col(query_col), F.col(text_col)))
    w = Window.partitionBy(*group_cols).orderBy(F.col("rerank_score").desc(), F.col("retrieval_rank").asc())
    out = scored.withColumnRenamed("rank", "retrieval_rank").withColumn("rank", F.row_number().over(w))
    if top_k is not None:
        out = out.where(F.col("rank") <= top_k)
    return out


# The four evaluation scenarios (name, expansion, rerank).
SCENARIOS = [
    ("Retrieval Only", False, False),
    ("Query Exp. + Retrieval", True, False),
    ("Retrieval + Reranker", False, True),
    ("Query Exp. + Retrieval + Reranker", True, True),
]


def batch_search(questions: DataFrame, expansions: DataFrame | None, corpus: DataFrame, k: int,
                 rerank_top_k: int | None = None, scenarios=None, dim: int = V.DEFAULT_DIM,
                 payload: list[str] | None = None, qid_col: str = "qid", text_col: str = "question") -> DataFrame:
    """All questions x scenarios in one job.

    Query texts are embedded once per (question, expanded?) and searched once;
    scenarios share those hits; reranking always scores against the original
    question.  Output ``hits(scenario, qid, rank, retrieval_rank, score,
    rerank_score, chunk_id, *payload)``.
    """
    scenarios = scenarios or SCENARIOS
    payload = payload or ["url", "url_preview", "text", "title", "domain", "file_path", "retrieval_date"]
    payload = [c for c in payload if c in corpus.columns]
    q = expanded_queries(questions.select(F.col(qid_col).alias("qid"), F.col(text_col).alias("question")), expansions)
    need_exp = any(s[1] for s in scenarios)
    variants = q.select("qid", "question", F.lit(False).alias("expanded"), F.col("question").alias("search_text"))
    if need_exp:
        variants = variants.unionByName(q.select("qid", "question", F.lit(True).alias("expanded"), "search_text"))
    variants = variants.withColumn("vkey", F.concat(F.col("qid").cast("string"), F.when(F.col("expanded"), F.lit(":x")).otherwise(F.lit(":o"))))
    qvec = variants.select(F.col("vkey").alias("qid"), V.hashed_term_vector(F.col("search_text"), dim).alias("embedding"))
    # one search for all scenarios: its (queries x k) rows are written, and every scenario
    # reads them back.  The corpus is expected to be a written index table, as both the
    # search and the join of its payload read it.
    hits = materialise(knn_exact(qvec, corpus, k, payload=payload), "search").withColumnRenamed("qid", "vkey")
    # no broadcast hint: the question set may be large; the optimizer picks the
    # join from size statistics (the hits side is queries x k rows)
    hits = hits.join(variants.select("vkey", "qid", "question", "expanded"), "vkey").drop("vkey")
    sc = hits.sparkSession.createDataFrame([(n, e, r) for n, e, r in scenarios], "scenario string, use_expansion boolean, use_rerank boolean")
    joined = hits.join(F.broadcast(sc), F.col("expanded") == F.col("use_expansion"))
    plain = joined.where(~F.col("use_rerank")).withColumn("retrieval_rank", F.col("rank")).withColumn("rerank_score", F.lit(None).cast("double"))
    rr = rerank(joined.where(F.col("use_rerank")), query_col="question", top_k=rerank_top_k or k,
                group_cols=["scenario", "qid"])
    cols = ["scenario", "qid", "rank", "retrieval_rank", "score", "rerank_score", "chunk_id", *payload]
    return plain.select(*cols).unionByName(rr.select(*cols))
