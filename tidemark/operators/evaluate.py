"""Retrieval evaluation: question sheets, relevance matching, per-question results, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import urls as U

# Depths reported by the evaluation.
K_VALUES = [1, 3, 5, 10, 25, 50, 100]


def questions_long(sheet: DataFrame, order_col: str | None = "row") -> tuple[DataFrame, DataFrame]:
    """Wide sheet -> ``questions(qid, question)`` and ``relevant(qid, pos, url)``.

    Column names are trimmed and lower-cased; every column whose name holds both
    ``relevant`` and ``doc`` is a relevant-URL column (sheet order = ``pos``);
    blank questions and blank URLs are dropped; values trimmed.
    """
    renamed = sheet.toDF(*[c.strip().lower() for c in sheet.columns])
    if "question" not in renamed.columns:
        raise ValueError("sheet needs a 'question' column")
    rel_cols = [c for c in renamed.columns if "relevant" in c and "doc" in c]
    if not rel_cols:
        raise ValueError("sheet needs at least one relevant doc column")
    if order_col and order_col.lower() in renamed.columns:
        qid = F.col(order_col.lower())
    else:
        # generated ids must not change if a task is recomputed: pin them in the
        # shared checkpoint folder
        from tidemark.session import cut_lineage

        renamed = cut_lineage(renamed.withColumn("_qid", F.monotonically_increasing_id()))
        qid = F.col("_qid")
    base = renamed.select(qid.alias("qid"), F.trim(F.col("question").cast("string")).alias("question"),
                          *[F.col(f"`{c}`").cast("string").alias(f"rel_{i}") for i, c in enumerate(rel_cols)])
    base = base.where(F.col("question").isNotNull() & (F.col("question") != ""))
    questions = base.select("qid", "question")
    long = base.unpivot(["qid"], [f"rel_{i}" for i in range(len(rel_cols))], "col", "url")
    long = long.select("qid", (F.regexp_extract("col", r"(\d+)$", 1).cast("int") + 1).alias("pos"),
                       F.trim("url").alias("url")).where(F.col("url").isNotNull() & (F.col("url") != ""))
    return questions, long


def main_domain_docs(relevant: DataFrame, sites: DataFrame | list[str] | str, url_col: str = "url") -> DataFrame:
    """Keep relevant URLs whose host is exactly a main site or ``www.`` + it."""
    host = U.url_host(F.col(url_col))
    if isinstance(sites, (str, list)):
        names = [sites] if isinstance(sites, str) else sites
        allowed = names + ["www." + s for s in names]
        return relevant.where(host.isin(allowed))
    keys = F.array(host, F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)))
    cand = relevant.withColumn("_k", F.explode(keys)).where(F.col("_k").isNotNull())
    s = sites.select(F.col("domain").alias("_k")).where(F.col("_k").isNotNull()).distinct()
    kept = cand.join(s, "_k", "left_semi").drop("_k")
    return kept.dropDuplicates(["qid", "pos"])


def with_main_questions(questions: DataFrame, relevant_main: DataFrame) -> DataFrame:
    """Questions that keep at least one relevant URL."""
    return questions.join(relevant_main.select("qid").distinct(), "qid", "left_semi")


def relevance_ranks(hits: DataFrame, relevant: DataFrame, exact: bool = False) -> DataFrame:
    """For every (scenario, question, relevant URL) the first rank whose ``url`` or
    ``url_preview`` matches; equi-join on the question, URL test as residual.

    By default a URL matches when either normalized form contains the other (so a
    site root matches every page); ``exact=True`` requires equal normalized URLs.
    """
    h = hits.select("scenario", "qid", "rank",
                    U.normalize_url(F.col("url")).alias("_nu"), U.normalize_url(F.col("url_preview")).alias("_np"))
    r = relevant.select("qid", "pos", F.col("url").alias("relevant_url"), U.normalize_url(F.col("url")).alias("_nr"))
    if exact:
        same = (F.col("_nu") == F.col("_nr")) | (F.col("_np") == F.col("_nr"))
    else:
        same = U.urls_match(F.col("_nu"), F.col("_nr")) | U.urls_match(F.col("_np"), F.col("_nr"))
    cond = (h.qid == r.qid) & same
    m = h.join(r, cond).select("scenario", h.qid.alias("qid"), "pos", "relevant_url", "rank")
    return m.groupBy("scenario", "qid", "pos", "relevant_url").agg(F.min("rank").alias("match_rank"))


def eval_questions(hits: DataFrame, questions: DataFrame, relevant: DataFrame, scenarios: DataFrame,
                   exact: bool = False) -> DataFrame:
    """Per scenario and question: retrieved count, found and missing URLs, ranks,
    success, rank of the first found URL in sheet order, best rank."""
    ranks = relevance_ranks(hits, relevant, exact)
    rel = relevant.join(questions.select("qid"), "qid", "left_semi")
    per = scenario_relevant(rel, scenarios).join(ranks.drop("relevant_url"), ["scenario", "qid", "pos"], "left")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "url", "match_rank")))
    agg = per.groupBy("scenario", "qid").agg(ordered.alias("_r"))
    found = F.filter("_r", lambda e: e["match_rank"].isNotNull())
    counts = hits.groupBy("scenario", "qid").agg(F.count("*").alias("retrieved_count"))
    out = agg.join(counts, ["scenario", "qid"], "left").select(
        "scenario", "qid",
        F.coalesce(F.col("retrieved_count"), F.lit(0)).cast("bigint").alias("retrieved_count"),
        F.size("_r").alias("n_relevant"),
        F.transform(found, lambda e: e["url"]).alias("found_docs"),
        F.transform(F.filter("_r", lambda e: e["match_rank"].isNull()), lambda e: e["url"]).alias("missing_docs"),
        F.transform(found, lambda e: e["match_rank"]).alias("all_ranks"),
        (F.size(found) > 0).alias("success"),
        F.get(F.transform(found, lambda e: e["match_rank"]), 0).alias("rank_of_first_match"),
        F.array_min(F.transform(found, lambda e: e["match_rank"])).alias("best_rank"),
    )
    return out


def scenario_relevant(relevant: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Relevant URLs repeated for every scenario (scenario table is a handful of rows)."""
    names = [r["scenario"] for r in scenarios.select("scenario").collect()]
    return relevant.select("qid", "pos", "url", F.explode(F.array(*[F.lit(n) for n in names])).alias("scenario"))


def scenario_metrics(evals: DataFrame) -> DataFrame:
    """successful, failed, accuracy, recall (found/relevant), mean first-match rank."""
    return evals.groupBy("scenario").agg(
        F.count_if("success").alias("successful"),
        (F.count("*") - F.count_if("success")).alias("failed"),
        (F.count_if("success") / F.count("*")).alias("accuracy"),
        (F.sum(F.size("found_docs")) / F.sum("n_relevant")).alias("recall"),
        F.avg("rank_of_first_match").alias("avg_rank_first_match"),
    )


def accuracy_at_k(evals: DataFrame, ks: list[int] | None = None) -> DataFrame:
    """Share of all questions with a relevant hit in the top k, per scenario and k."""
    ks = ks or K_VALUES
    e = evals.select("scenario", "best_rank", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    return e.groupBy("scenario", "k").agg(
        (F.count_if(F.col("best_rank") <= F.col("k")) / F.count("*")).alias("accuracy"))


def accuracy_report(acc: DataFrame, ks: list[int] | None = None) -> DataFrame:
    """Methods x k table of percentages with one decimal."""
    ks = ks or K_VALUES
    pct = F.format_string("%.1f%%", F.round(F.col("accuracy") * 100, 1))
    return acc.groupBy("scenario").pivot("k", ks).agg(F.first(pct)).select(
        "scenario", *[F.col(str(k)).alias(f"k_{k}") for k in ks])


def eval_export(evals: DataFrame, metrics: DataFrame, acc: DataFrame, path: str, config: dict) -> None:
    """Evaluation export: config, per-scenario metrics with accuracy at k, and
    per-question results as JSON lines under ``path``."""
    spark = evals.sparkSession
    import json

    spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "config string").write.mode("overwrite").text(f"{path}/config")
    per_k = acc.groupBy("scenario").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat(F.lit("k_"), F.col("k").cast("string")), F.col("accuracy")))).alias("accuracy_at_k"))
    metrics.join(per_k, "scenario", "left").write.mode("overwrite").json(f"{path}/metrics")
    evals.write.mode("overwrite").json(f"{path}/results")
