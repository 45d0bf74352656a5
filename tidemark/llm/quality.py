"""Quality classifier by Bradley-Terry pairwise ranking.

Each document gets a strength ``w . x`` from surface features of its whole text; of a
good and a bad training document the good one should be stronger, with logistic loss on
the difference of their features, over all pairs of all training documents.  A quantile of
all training strengths is the threshold, placed at the score 0.3."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Widths of the strength bins in which the fit and the threshold count pairs, and the strength beyond which all share a bin.
FIT_WIDTH, CUT_WIDTH, MOST = 1 / 32, 1 / 256, 40
MAX_STEPS = 30
#: The score at the threshold.
CUT = 0.3
L2 = 1e-3

SYMBOLS = "#$%&*+/<=>@[\\]^_`{|}~"
SENTENCE = ".,;:!?"
RUNS = re.compile(r"[^\w\s]{2,}")

FEATURES = [
    "log_words", "distinct_words", "adjacent_repeats", "symbols", "sentence_marks", "symbol_runs", "lone_symbols", "mean_word",
    "long_words", "short_words", "distinct_lines", "line_words", "digits", "capitals", "compressed",
]


def features(text: str) -> list[float]:
    """Surface features of a whole text, all finite and in small ranges; an empty text has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = [x for x in text.split("\n") if x.strip()]
    raw = text.encode("utf-8", "surrogatepass")
    repeats = sum(map(str.__eq__, words, words[1:])) if n > 1 else 0
    return [
        float(np.log1p(n)),
        len(set(words)) / n ** 0.9,
        repeats / n,
        min(1.0, sum(map(text.count, SYMBOLS)) / n),
        min(1.0, sum(map(text.count, SENTENCE)) / n),
        min(1.0, len(RUNS.findall(text)) / n),
        sum(map(words.count, "|-*#=+")) / n,
        min(3.0, float(lengths.mean()) / 10),
        float((lengths > 14).mean()),
        float((lengths < 4).mean()),
        len(set(lines)) / len(lines),
        min(3.0, float(np.log1p(n / len(lines)) / 2)),
        sum(map(text.count, "0123456789")) / chars,
        min(1.0, sum(1 for w in words if w[0].isupper()) / n),
        len(zlib.compress(raw, 1)) / (len(raw) + 50),
    ]


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def _features(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t or "") for t in texts], dtype=object)

    return look(text)


def training_labels(labels: DataFrame, label: str, train: Column) -> DataFrame:
    """(doc_id, y) of the labelled training documents, each once."""
    return labels.filter(train & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("y")).dropDuplicates(["doc_id"])


def training_rows(labelled: DataFrame, labels: DataFrame, label: str, train: Column, rows: int) -> DataFrame:
    """Up to ``rows`` labelled training documents with their texts, up to half of them for each class.

    The sample is the rows with the smallest hash of doc_id, drawn from the label
    table alone; being bounded, it is broadcast to the texts."""
    own = training_labels(labels, label, train)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = own.filter("y = 1").orderBy(*order).limit(rows // 2).unionByName(own.filter("y = 0").orderBy(*order).limit(rows // 2))
    return labelled.select("doc_id", "text").join(F.broadcast(some), "doc_id")


def _binned(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, width: float, products: bool) -> list[np.ndarray]:
    """For bad and good documents the sums of ``[1, strength, z, z z']`` in each bin of strength that holds any, z being the scaled features.

    Without ``products`` only the counts and strengths are summed.  Every task adds up its own
    rows, so what is shuffled and collected is bounded by the number of bins."""
    bins = 2 * int(MOST / width)
    across, down = np.triu_indices(len(w))
    size = 2 + (len(w) + len(across) if products else 0)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2 * bins, size))
        for b in batches:
            if len(b):
                z = (np.array(b["x"].tolist(), dtype=float) - mean) / scale
                s = z @ w
                at = np.clip(np.floor(s / width).astype(np.int64) + bins // 2, 0, bins - 1) + bins * b["y"].to_numpy().astype(np.int64)
                parts = [np.ones((len(z), 1)), s[:, None], *([z, z[:, across] * z[:, down]] if products else [])]
                order = np.argsort(at, kind="stable")
                held, starts = np.unique(at[order], return_index=True)
                sums[held] += np.add.reduceat(np.hstack(parts)[order], starts)
        some = np.flatnonzero(sums[:, 0])
        if len(some):
            yield pd.DataFrame({"at": some, "sums": list(sums[some])})

    parts = rows.mapInPandas(add, "at long, sums array<double>").select("at", F.posexplode("sums").alias("i", "v"))
    got = parts.groupBy("at", "i").agg(F.sum("v").alias("v")).toPandas()  # bins x sums
    whole = np.zeros((2 * bins, size))
    whole[got["at"].to_numpy(dtype=np.int64), got["i"].to_numpy(dtype=np.int64)] = got["v"].to_numpy(dtype=float)
    return [half[half[:, 0] > 0] for half in (whole[:bins], whole[bins:])]


def _pair_loss(bad: np.ndarray, good: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logistic loss of all good-bad pairs with its gradient and Hessian, the strengths of a bin taken as their mean."""
    k = len(w)
    across, down = np.triu_indices(k)
    nb, ng = bad[:, 0], good[:, 0]
    pairs = nb.sum() * ng.sum()
    ahead = good[:, 1][:, None] / ng[:, None] - (bad[:, 1] / nb)[None, :]
    p = 1 / (1 + np.exp(np.clip(ahead, -40, 40)))
    h = p * (1 - p)
    zb, zg = bad[:, 2:2 + k], good[:, 2:2 + k]
    loss = float(ng @ np.logaddexp(0, -ahead) @ nb / pairs + 0.5 * L2 * (w @ w))
    grad = ((ng @ p) @ zb - (p @ nb) @ zg) / pairs + L2 * w
    own = np.zeros((k, k))
    own[across, down] = ((h @ nb) @ good[:, 2 + k:] + (ng @ h) @ bad[:, 2 + k:]) / pairs
    own = own + np.triu(own, 1).T
    cross = zg.T @ h @ zb / pairs
    return loss, grad, own - cross - cross.T + (L2 + 1e-9) * np.eye(k)


def fit_pairs(rows: DataFrame) -> dict:
    """Bradley-Terry weights by Newton steps, and the threshold on the strengths, from all ``rows`` (y, x).

    The loss is over every pair of a good and a bad row: rows are added up in narrow bins of
    strength, one pass of the cluster for each step, and the pairs are counted between
    bins.  Without both classes the strengths are zero and every score is 0.5."""
    k = len(FEATURES)
    zero, one = np.zeros(k), np.ones(k)
    bad, good = _binned(rows, zero, one, zero, 1.0, True)
    if not len(good) or not len(bad):
        return {"mean": [0.0] * k, "scale": [1.0] * k, "w": [0.0] * k, "cut": 0.0, "at": 0.0}
    total = bad.sum(axis=0) + good.sum(axis=0)
    mean = total[2:2 + k] / total[0]
    across, down = np.triu_indices(k)
    scale = np.sqrt(np.maximum(total[2 + k:][across == down] / total[0] - mean * mean, 0)) + 1e-6
    mean, scale = np.round(mean, 10), np.round(scale, 10)  # sums differ in their last digits by the order of the tasks

    w = zero
    loss, grad, hess = _pair_loss(*_binned(rows, mean, scale, w, FIT_WIDTH, True), w)
    for _ in range(MAX_STEPS):
        step = np.linalg.solve(hess, -grad)
        if np.abs(step).max() < 1e-6:
            break
        then = _pair_loss(*_binned(rows, mean, scale, w + step, FIT_WIDTH, True), w + step)
        while then[0] > loss and np.abs(step).max() > 1e-6:
            step = step / 2
            then = _pair_loss(*_binned(rows, mean, scale, w + step, FIT_WIDTH, True), w + step)
        gain, w, (loss, grad, hess) = loss - then[0], w + step, then
        if gain < 1e-9:
            break
    w = np.round(w, 8)

    # the quantile that separates the classes best, both classes weighing the same
    bad, good = _binned(rows, mean, scale, w, CUT_WIDTH, False)
    both = np.vstack([bad, good])
    s, which, n = both[:, 1] / both[:, 0], np.repeat([0, 1], [len(bad), len(good)]), both[:, 0]
    order = np.argsort(s, kind="stable")
    s, which, n = s[order], which[order], n[order]
    levels = np.linspace(0, 1, 401)
    upto = np.cumsum(n)
    place = lambda q: np.interp(q * (upto[-1] - 1), np.column_stack([upto - n, upto - 1]).ravel(), np.repeat(s, 2))
    cuts = place(levels)
    below = [np.concatenate([[0], np.cumsum(n * (which == c))])[np.searchsorted(s, cuts)] for c in (0, 1)]
    won = below[0] / bad[:, 0].sum() + 1 - below[1] / good[:, 0].sum()
    best = np.flatnonzero(won >= won.max() - 1e-12)
    return {"mean": mean.tolist(), "scale": scale.tolist(), "w": w.tolist(), "cut": float(np.round(place(levels[best].mean()), 8)), "at": float(np.log(CUT / (1 - CUT)))}


def score_quality(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``held_out``, ``score`` (0 to 1, higher is better) and ``predicted`` (1 from 0.3 on) to each document.

    ``docs`` has doc_id and text, ``labelled`` the texts (doc_id, text) that ``labels``
    (doc_id, quality) tells of.  Only the text enters a score; null texts count as
    empty; labels other than 0 and 1 and repeated label rows are ignored; same-named
    input columns are replaced; repeated rows stay repeated, and equal texts tie.  A very long
    text is read whole, in memory of a few times its size; no documents give none."""
    own = training_labels(labels, "quality", ~is_held_out(F.col("doc_id")))
    # features before the join: texts are never shuffled, whatever the size of the labels
    rows = labelled.select("doc_id", _features("text").alias("x")).join(own, "doc_id")
    model = fit_pairs(stored(rows.select("y", "x"), "quality-features"))
    mean, scale, w = (np.array(model[k]) for k in ("mean", "scale", "w"))
    cut, at = model["cut"], model["at"]

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t or "") for t in texts], dtype=float).reshape(len(texts), len(mean))
            yield pd.Series(1 / (1 + np.exp(-np.clip((x - mean) / scale @ w - cut + at, -30, 30))))

    return docs.withColumns({"held_out": is_held_out(F.col("doc_id")), "score": score("text")}).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))
