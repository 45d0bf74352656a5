"""User functions of retrieval: query expansion and reranking, with their defaults."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.sources.epochs import Store

EXPANSIONS = "expansions"
#: The usual constants of BM25.
BM25_K1, BM25_B = 1.2, 0.75


# ---------------------------------------------------------------- expansion
def stored_expansions(store: Store) -> DataFrame | None:
    """(key, question, expanded, status, error, sent): the last result of each distinct question and how often it was sent."""
    rows = store.read(EXPANSIONS)
    if rows is None:
        return None
    last = F.max_by(F.struct("question", "expanded", "status", "error"), "epoch").alias("r")
    return rows.groupBy("key").agg(last, F.count(F.lit(1)).alias("sent")).select("key", "r.*", "sent")


def expand_questions(spark: SparkSession, store: Store, questions: DataFrame, fn: Callable[[list[str]], Sequence[str | None]],
                     text_col: str = "question", batch_rows: int = 64) -> DataFrame:
    """Send each distinct question that has no good result yet to ``fn`` and return all stored results.

    Results are kept by the sha256 of the question and are written before they are used, so
    a question is paid for once however many rows and runs ask it.  A question whose
    result is empty, or for which ``fn`` raises, is kept with that status and is sent
    again by the next run.  Null and blank questions are not sent."""
    text = F.trim(F.col(text_col))
    asked = questions.filter(text != "").select(F.sha2(text, 256).alias("key"), text.alias("question")).distinct()
    known = stored_expansions(store)
    if known is not None:
        asked = asked.join(known.filter("status = 'ok'").select("key"), "key", "left_anti")

    def one(question: str) -> tuple[str | None, str, str | None]:
        try:
            got = (list(fn([question]))[0] or "").strip()
            return got, "ok" if got else "empty", None
        except Exception as e:  # noqa: BLE001 - what a user's function raises is part of the result
            return None, "failed", str(e)[:500]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), batch_rows):
                part = b.iloc[lo:lo + batch_rows]
                texts = part["question"].tolist()
                try:
                    got = [(g or "").strip() for g in fn(texts)]
                    rows = [(g, "ok" if g else "empty", None) for g in got] if len(got) == len(texts) else [one(t) for t in texts]
                except Exception:  # noqa: BLE001 - one bad question must not cost the others their results
                    rows = [one(t) for t in texts]
                yield pd.DataFrame({"key": part["key"].tolist(), "question": texts, "expanded": [r[0] for r in rows],
                                    "status": [r[1] for r in rows], "error": [r[2] for r in rows]})

    schema = "key string, question string, expanded string, status string, error string"
    epoch = f"run-{len(store.published()):06d}"
    store.write(EXPANSIONS, epoch, asked.mapInPandas(run, schema))
    store.publish(epoch)
    return stored_expansions(store)


def with_expansions(questions: DataFrame, results: DataFrame, text_col: str = "question") -> DataFrame:
    """Add ``search_text`` (the expansion, else the question) and the result's ``status`` (null for blank questions)."""
    r = results.select(F.col("key").alias("__key"), "expanded", "status", "sent")
    j = questions.join(r, F.sha2(F.trim(F.col(text_col)), 256) == F.col("__key"), "left").drop("__key")
    good = F.when(F.col("status") == "ok", F.col("expanded"))
    return j.withColumn("search_text", F.coalesce(good, F.col(text_col))).drop("expanded")


# ---------------------------------------------------------------- reranking
def rerank_by(hits: DataFrame, scorer: Callable[[str, list[str]], Sequence[float]], group_cols: list[str],
              query_col: str = "question", text_col: str = "text", id_col: str = "chunk_id") -> DataFrame:
    """Add ``rerank_score`` and the new ``rank`` (the old one stays as ``retrieval_rank``) by a user's ``scorer(question, texts)``.

    The hits of one question come together and are scored in one call, in their
    retrieval order; equal scores keep that order, a null score or one that is no number
    comes last.  Groups hold the hits of one search, so k bounds them."""
    fields = hits.select(*group_cols, id_col).schema

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["rank", id_col])
        got = [float("nan") if s is None else float(s) for s in scorer(batch[query_col].iloc[0], batch[text_col].fillna("").tolist())]
        if len(got) != len(batch):
            raise ValueError(f"{len(got)} scores for {len(batch)} texts")
        return batch[[*group_cols, id_col]].assign(rerank_score=got)

    scored = hits.groupBy(*group_cols).applyInPandas(score, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", rerank_score double")
    return _reranked(hits.join(scored, [*group_cols, id_col]), group_cols)


def _reranked(scored: DataFrame, group_cols: list[str]) -> DataFrame:
    order = F.when(F.isnan("rerank_score"), None).otherwise(F.col("rerank_score")).desc_nulls_last()
    w = Window.partitionBy(*group_cols).orderBy(order, "retrieval_rank")
    return scored.withColumnRenamed("rank", "retrieval_rank").withColumn("rank", F.row_number().over(w))


def term_statistics(corpus: DataFrame, text_col: str = "text") -> tuple[DataFrame, int, float]:
    """((term, df), rows, mean terms): in how many rows of ``corpus`` each term occurs."""
    of_row = corpus.select(V.terms(F.col(text_col)).alias("t"))
    n, mean = of_row.agg(F.count(F.lit(1)), F.avg(F.size("t"))).first()
    return of_row.select(F.explode(F.array_distinct("t")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), n, mean or 0.0


def rerank_bm25(hits: DataFrame, statistics: tuple[DataFrame, int, float], group_cols: list[str],
                query_col: str = "question", text_col: str = "text", id_col: str = "chunk_id") -> DataFrame:
    """The default scorer: BM25 of the question's distinct terms in each hit, with the corpus's document frequencies.

    Terms that the corpus lacks and texts without the question's terms score 0."""
    df, n, mean = statistics
    keys = [*group_cols, id_col]
    texts = hits.select(*keys, V.terms(F.col(query_col)).alias("q"), V.terms(F.col(text_col)).alias("t"))
    per = texts.select(*keys, "t", F.size("t").alias("len"), F.explode(F.array_distinct("q")).alias("term"))
    per = per.select(*keys, "len", "term", F.size(F.filter("t", lambda x: x == F.col("term"))).alias("tf")).filter("tf > 0")
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    share = F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("len") / F.lit(max(mean, 1e-9))))
    sums = per.join(df, "term").groupBy(*keys).agg(F.round(F.sum(idf * share), 9).alias("rerank_score"))
    scored = hits.join(sums, keys, "left").withColumn("rerank_score", F.coalesce("rerank_score", F.lit(0.0)))
    return _reranked(scored, group_cols)
