"""Search over the page corpus: questions -> expansion -> embedding -> top-k -> rerank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import search as R
from tidemark.plans import indexing as I
from tidemark.sources import derived as S
from tidemark.sources.tables import table


def top_hits(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """Every benchmark question, all scenarios, top ``k`` hits with URL and preview."""
    inp = I.inputs(spark, sf_dir)
    bench, pages = table(spark, sf_dir, "benchmark"), inp.pages
    questions = bench.select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    corpus = I.page_chunks(spark, sf_dir, inp)
    hits = R.batch_search(questions, S.expansions(bench, pages), corpus, k)
    return hits.select("scenario", "qid", "rank", "retrieval_rank", "score", "rerank_score", "chunk_id",
                       "url", "url_preview", "title", "retrieval_date")
