"""Search against brute force; rerank; evaluation metrics on hand-made hits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import search as R


def test_knn_exact_matches_brute_force(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), "embedding")
    got = R.knn_exact(q, e, 5, id_col="vec_id").collect()
    pdf = e.toPandas()
    X = np.vstack(pdf.embedding.map(lambda v: np.asarray(v, dtype=np.float64)))
    ids = pdf.vec_id.to_numpy()
    nrm = np.einsum("ij,ij->i", X, X)
    S = (X @ X.T) / np.sqrt(nrm[:, None] * nrm[None, :])
    want = {}
    for i, qid in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda j: (-S[i, j], ids[j]))[:5]
        want[qid] = [ids[j] for j in order]
    have = {}
    for r in sorted(got, key=lambda r: (r.qid, r["rank"])):
        have.setdefault(r.qid, []).append(r.vec_id)
    assert have == want


def test_knn_blocks_equal_single_block(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), "embedding")
    one = R.knn_exact(q, e, 3, id_col="vec_id").orderBy("qid", "rank").collect()
    many = R.knn_exact(q, e, 3, id_col="vec_id", query_block=50, corpus_block=30).orderBy("qid", "rank").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in many]


def test_ties_broken_by_id_and_zero_query(spark):
    corpus = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "chunk_id string, embedding array<float>")
    qs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "qid int, embedding array<float>")
    got = [(r.qid, r["rank"], r.chunk_id) for r in R.knn_exact(qs, corpus, 2).orderBy("qid", "rank").collect()]
    assert got == [(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 2, "b")]


def test_lsh_candidates_are_exact_scores(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), "embedding")
    approx = R.knn_lsh(q, e, 5, dim=64, id_col="vec_id")
    self_hit = approx.where((F.col("rank") == 1)).where(F.col("qid") == F.col("vec_id")).count()
    assert self_hit == e.count()  # every vector finds itself first
    rec = R.recall_vs_exact(approx, R.knn_exact(q, e, 5, id_col="vec_id"), id_col="vec_id")
    assert rec.agg(F.avg("recall")).first()[0] >= 0.9
    assert {r["count"] for r in approx.groupBy("qid").count().collect()} == {5}


@pytest.mark.parametrize("n, spread", [(3000, 1.0), (8000, 1.0), (8000, 0.25)])
def test_lsh_recall_at_sizes(spark, n, spread):
    rng = np.random.default_rng(n)
    v = rng.standard_normal((n // 20, 64)).repeat(20, axis=0) * (1 - spread) + spread * rng.standard_normal((n, 64))
    e = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>").cache()
    q = e.filter("vec_id % 100 = 3").select(F.col("vec_id").alias("qid"), "embedding")
    rec = R.recall_vs_exact(R.knn_lsh(q, e, 10, dim=64, id_col="vec_id"), R.knn_exact(q, e, 10, id_col="vec_id"), id_col="vec_id")
    assert rec.agg(F.avg("recall")).first()[0] >= 0.9


def test_lsh_tops_up_short_queries(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = e.select(F.col("vec_id").alias("qid"), "embedding").limit(20)
    few = R.knn_lsh(q, e, 30, dim=64, id_col="vec_id", bits=12, tables=1)
    assert {r["count"] for r in few.groupBy("qid").count().collect()} == {30}


def test_width_mismatch_is_an_error(spark):
    corpus = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0])], "chunk_id string, embedding array<float>")
    qs = spark.createDataFrame([(1, [1.0, 0.0])], "qid int, embedding array<float>")
    with pytest.raises(Exception, match="width 1 among"):
        R.knn_exact(qs, corpus, 1).collect()


def test_rerank_stable_and_empty_text_last(spark):
    hits = spark.createDataFrame([(1, 1, "x", "alpha"), (1, 2, "y", "beta gamma"), (1, 3, "z", ""), (1, 4, "w", "beta")],
                                 "qid int, rank int, chunk_id string, text string")
    hits = hits.withColumn("rerank_query", F.lit("beta gamma"))
    got = [(r.chunk_id, r["rank"], r.retrieval_rank) for r in R.rerank(hits, top_k=3).orderBy("rank").collect()]
    assert got == [("y", 1, 2), ("w", 2, 4), ("x", 3, 1)]


def test_expansion_fallback(spark):
    qs = spark.createDataFrame([(1, "q1"), (2, "q2"), (3, "q3")], "qid int, question string")
    ex = spark.createDataFrame([(1, "  more words "), (2, "   ")], "qid int, expanded string")
    got = {r.qid: r.search_text for r in R.expanded_queries(qs, ex).collect()}
    assert got == {1: "more words", 2: "q2", 3: "q3"}


def _eval_fixture(spark):
    hits = spark.createDataFrame([
        ("s", 1, 1, "https://uni.example/a/index.html", "https://uni.example/a"),
        ("s", 1, 2, "https://uni.example/b.html", "https://uni.example/b.html"),
        ("s", 2, 1, "https://uni.example/c", "https://uni.example/c"),
    ], "scenario string, qid int, rank int, url string, url_preview string")
    rel = spark.createDataFrame([(1, 1, "https://uni.example/b"), (1, 2, "https://uni.example/a/"), (2, 1, "https://uni.example/zz"),
                                 (3, 1, "https://uni.example/q")], "qid int, pos int, url string")
    qs = spark.createDataFrame([(1, "q"), (2, "r"), (3, "t")], "qid int, question string")
    sc = spark.createDataFrame([("s",)], "scenario string")
    return hits, rel, qs, sc


def test_eval_rank_of_first_match_follows_sheet_order(spark):
    hits, rel, qs, sc = _eval_fixture(spark)
    ev = {r.qid: r for r in E.eval_questions(hits, qs, rel, sc).collect()}
    # relevant #1 (b) ranks 2, relevant #2 (a) ranks 1: first match follows list order
    assert ev[1].rank_of_first_match == 2 and ev[1].best_rank == 1 and ev[1].success
    assert not ev[2].success and ev[2].retrieved_count == 1
    assert ev[3].retrieved_count == 0 and ev[3].missing_docs == ["https://uni.example/q"]


def test_accuracy_at_k_monotone_and_counts_all_questions(spark):
    hits, rel, qs, sc = _eval_fixture(spark)
    ev = E.eval_questions(hits, qs, rel, sc)
    acc = [r.accuracy for r in E.accuracy_at_k(ev).orderBy("k").collect()]
    assert acc == sorted(acc)
    assert abs(acc[0] - 1 / 3) < 1e-12
    m = E.scenario_metrics(ev).first()
    assert m.successful == 1 and m.failed == 2 and abs(m.recall - 2 / 4) < 1e-12 and m.avg_rank_first_match == 2.0


def test_main_domain_filter(spark):
    rel = spark.createDataFrame([(1, 1, "https://uni.example/x"), (1, 2, "https://www.uni.example/y"), (2, 1, "https://staff.uni.example/z"),
                                 (3, 1, "http://www.www.uni.example/")], "qid int, pos int, url string")
    got = sorted((r.qid, r.pos) for r in E.main_domain_docs(rel, "uni.example").collect())
    assert got == [(1, 1), (1, 2)]
    sites = spark.createDataFrame([("uni.example",)], "domain string")
    assert sorted((r.qid, r.pos) for r in E.main_domain_docs(rel, sites).collect()) == got


def test_knn_payload_join_back_in_block_mode(spark):
    corpus = spark.createDataFrame([(f"c{i}", [float(i % 7), 1.0], f"text {i}") for i in range(40)],
                                   "chunk_id string, embedding array<float>, text string")
    qs = spark.createDataFrame([(q, [float(q), 1.0]) for q in range(12)], "qid int, embedding array<float>")
    one = R.knn_exact(qs, corpus, 4, payload=["text"]).orderBy("qid", "rank").collect()
    blocks = R.knn_exact(qs, corpus, 4, payload=["text"], query_block=3, corpus_block=7).orderBy("qid", "rank").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in blocks]
    assert all(r.text == "text " + r.chunk_id[1:] for r in one)


def test_exact_url_matching_option(spark):
    hits = spark.createDataFrame([("s", 1, 1, "https://uni.example", "https://uni.example")],
                                 "scenario string, qid int, rank int, url string, url_preview string")
    rel = spark.createDataFrame([(1, 1, "https://uni.example/page")], "qid int, pos int, url string")
    assert E.relevance_ranks(hits, rel).count() == 1            # root contains-match by default
    assert E.relevance_ranks(hits, rel, exact=True).count() == 0


def test_empty_query_vectors_rank_by_id(spark):
    corpus = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [0.0, 1.0])], "chunk_id string, embedding array<float>")
    qs = spark.createDataFrame([(1, [])], "qid int, embedding array<float>")
    got = [(r["rank"], r.chunk_id, r.score) for r in R.knn_exact(qs, corpus, 2).orderBy("rank").collect()]
    assert got == [(1, "a", 0.0), (2, "b", 0.0)]


@pytest.mark.parametrize("n", [500, 2000, 12000])
def test_inverted_file_recall_at_sizes(spark, n):
    from tidemark.operators import ann

    rng = np.random.default_rng(n)
    v = rng.standard_normal((n, 64))
    v[n // 2 : n // 2 + 400] = v[n // 2]  # a group of copies larger than what is scored exactly
    rows = [(i, x) for i, x in enumerate(v.tolist())] + [(n, None), (n + 1, [0.0] * 64)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).cache()
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    index = ann.build(e)
    assert index.codes.count() == index.rows == n + 2 and index.codes.select("vec_id").distinct().count() == n + 2
    exact = R.knn_exact(q, e, 10, id_col="vec_id").withColumnRenamed("vec_id", "id")
    found = ann.knn_ivf(q, index, 10)
    assert {r["count"] for r in found.groupBy("qid").count().collect()} == {10}
    rec = ann.recall_report(found, exact, index.rows).agg(F.avg("recall"), F.max("share_scored")).first()
    assert rec[0] >= 0.9 and (n < 12000 or rec[1] <= 0.2)
    # every cell visited and every code scored exactly: the exact result
    whole = ann.knn_ivf(q.limit(3), index, 10, visits=len(index.books.centroids), rescored=n).select("qid", "rank", "score", "id")
    want = exact.join(q.limit(3).select("qid"), "qid", "left_semi").select("qid", "rank", "score", "id")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, want.collect()))


def _by_sql(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _same_hits(spark, rows, path):
    """The hits of ``knn_exact`` over ``rows``, after they were found equal to its SQL's."""
    import duckdb

    import __spark_entry__ as entry

    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    got = _by_sql(entry.queries()["knn_exact"](spark, str(path)).select("qid", "rank", "vec_id", "score").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/embeddings.parquet/*.parquet')")
    want = _by_sql(con.execute(f"SELECT qid, rank, vec_id, score FROM ({entry.oracle_sql()['knn_exact']})").fetchall())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)
    return got


def test_knn_exact_query_searches_for_every_row(spark, tmp_path):
    v = np.random.default_rng(5).standard_normal((130, 8)).astype("float32").tolist()
    v[40:70] = [v[40]] * 30  # more copies than hits
    rows = [(1000 + i, x) for i, x in enumerate(v)] + [(7, [0.0] * 8), (8, None)]  # two of these ids are divisible by 100
    got = _same_hits(spark, rows, tmp_path)
    assert {r[0] for r in got} == {r[0] for r in rows} and len(got) == 10 * len(rows)


def test_knn_exact_query_keeps_wide_and_null_ids(spark, tmp_path):
    v = np.random.default_rng(6).standard_normal((40, 8)).astype("float32").tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [(3, v[7])]  # an id that comes twice
    rows += [(2**60 + 1, v[5]), (2**60 + 3, v[5]), (None, v[5]), (None, v[9])]
    got = _same_hits(spark, rows, tmp_path)
    assert {r[0] for r in got} == {r[0] for r in rows}


@pytest.mark.parametrize("kind", ["float32", "float64"])
def test_best_rows_are_those_of_plain_scores(kind):
    rng = np.random.default_rng(8)
    for turn in range(24):
        n, width, k = int(rng.integers(1, 900)), int(rng.integers(1, 40)), int(rng.integers(1, 15))
        C, Q = rng.standard_normal((n, width)), rng.standard_normal((50, width))
        if turn % 2:
            C[: n // 2] = C[0]  # copies
        if turn % 3 == 1:
            C[n // 3 :] = C[0] + 1e-6 * rng.standard_normal((n - n // 3, width))  # near copies
            Q[::2] = C[0]
        if turn % 4 == 2:
            C *= 10.0 ** rng.integers(-30, 30, (n, 1)) if kind == "float32" else 10.0 ** rng.integers(-90, 90, (n, 1))
        C[::7], Q[::5] = 0, 0
        C, Q, order = C.astype(kind), Q.astype(kind), rng.permutation(n)
        query, row, score = R._best(Q, C, order, k)
        assert sorted(set(query.tolist())) == list(range(len(Q)))
        for i in range(len(Q)):
            plain = R.row_cosines(np.repeat(Q[i : i + 1].astype(float), n, axis=0), C.astype(float))
            by = np.lexsort((order, -plain))[:k]
            assert row[query == i].tolist() == by.tolist() and score[query == i].tolist() == plain[by].tolist()
