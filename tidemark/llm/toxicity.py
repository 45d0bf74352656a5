"""Toxicity by weak supervision.

1. A lexicon is drawn from labelled training rows: words, and word beginnings that one text
   holds in one, two or three different words.  A beginning that is rare in a text with many
   words tells little; three words that share it tell much, also where a language
   has only a few labelled texts.
2. Voters look at every document: the lexicon dealt into several lists, repeated
   beginnings, rates and patterns.  A voter fires or stays silent.
3. A generative label model gets the voters' rates and joint rates over all documents.
   Given the class, voters fire independently, so that covariances off the diagonal are a
   rank-one product of their edges; pairs that agree far more than that are correlated and
   share their weight.
4. The posterior class of training rows under that model, not their labels, trains a
   linear classifier over lexicon entries, patterns and rates."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .fits import logistic
from .quality import training_rows
from .shingles import shingle_sets

#: Bounds of the labelled sample and of the lexicon, and the log odds that an entry needs.
SAMPLE_ROWS, LEXICON, ODDS = 20_000, 400, 3.0
#: The likelihood ratio of an entry must come up to the log of the entries tried, less this: the label model weighs what gets in.
LEEWAY = 1.0
#: Lengths of word beginnings that may become entries, besides whole words, and how many different words of a text share them.
STEMS, DOSES = (4, 5, 6, 7), (1, 2, 3)
LISTS = 10
CUT = 0.3
WORDS = re.compile(r"[^\W\d_]+")
PATTERNS = {"exclaim": re.compile(r"!{2,}|\?!")}


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(True))


def _entries(text: str) -> set[str]:
    """Words of a text (``word$``), and its word beginnings with the number of different words that share them (``begin|2``), in lower case."""
    words = set(WORDS.findall(text.lower()))
    shared = Counter(w[:n] for w in words for n in STEMS if len(w) >= n)
    return {w + "$" for w in words if len(w) > 2} | {f"{b}|{d}" for b, k in shared.items() for d in DOSES if k >= d}


def learn_lexicon(rows: DataFrame, most: int = LEXICON) -> list[str]:
    """Entries that mark toxic rows, the strongest first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for b in batches:
            for text, y in zip(b["text"], b["y"]):
                (toxic if y else clean).update(_entries(text or ""))
        keys = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"entry": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]})

    totals = rows.groupBy("y").count().toPandas().set_index("y")["count"]
    n1, n0 = int(totals.get(1, 0)), int(totals.get(0, 0))
    if not n1 or not n0:
        return []
    counts = rows.select("text", "y").mapInPandas(count, "entry string, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = stored(counts, "entries")
    # log odds, and the likelihood ratio against an entry that does not care, held against the number of entries of its kind tried
    kind = F.substring("entry", -1, 1)
    tried = {r["kind"]: r["count"] for r in counts.filter("toxic > 1").groupBy(kind.alias("kind")).count().collect()}  # a few kinds
    bar = F.create_map(*[F.lit(v) for k, n in (tried or {"": 0}).items() for v in (k, math.log(n + 1) - LEEWAY)])
    share, df = n1 / (n1 + n0), F.col("toxic") + F.col("clean")
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    ratio = F.col("toxic") * F.log(F.col("toxic") / (df * share)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (df * (1 - share)))).otherwise(0)
    strong = counts.filter("toxic > 1").withColumns({"odds": odds, "ratio": ratio}).filter((F.col("odds") >= ODDS) & (F.col("ratio") >= F.try_element_at(bar, kind)))
    top = strong.orderBy(F.desc("ratio"), "entry").limit(4 * most).toPandas()
    kept: list[str] = []
    # of nested entries of a kind only the strongest, and of equally strong ones the widest
    for _, e in sorted(zip(-top["ratio"].round(6), top["entry"]), key=lambda r: (r[0], len(r[1]), r[1])):
        word, same = e.rstrip("$|123"), [k for k in kept if k[-1] == e[-1]]
        if not any(word.startswith(k.rstrip("$|123")) or k.startswith(word) for k in same):
            kept.append(e)
    return kept[:most]


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows without the near copies of others: one row for each of four min-hashes of word shingles.

    Copies of one document would otherwise make each of its words look like a mark of its class."""

    @F.pandas_udf("array<long>")
    def mins(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        turns = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
        for texts in batches:
            out = [[int((s * t).min() >> np.uint64(1)) for t in turns] if len(s) else [0] * len(turns) for s in shingle_sets(texts.tolist())]
            yield pd.Series(out, dtype=object)

    marked = rows.withColumn("__m", mins("text"))
    for k in range(4):
        first = Window.partitionBy(F.col("__m")[k]).orderBy("doc_id")
        marked = marked.withColumn("__turn", F.row_number().over(first)).filter("__turn = 1").drop("__turn")
    return marked.drop("__m")


class Voters:
    """Lexicon lists, repeated beginnings, rates and patterns over whole texts; built once for a task."""

    def __init__(self, lexicon: list[str]):
        self.lexicon = lexicon
        self.trie = ahocorasick.Automaton()
        whole = {e[:-1]: i for i, e in enumerate(lexicon) if e.endswith("$")}
        doses: dict[str, list[tuple[int, int]]] = {}
        for i, e in enumerate(lexicon):
            if not e.endswith("$"):
                doses.setdefault(e[:-2], []).append((int(e[-1]), i))
        for word in whole.keys() | doses.keys():
            self.trie.add_word(word, (len(word), whole.get(word), doses.get(word, [])))
        if lexicon:
            self.trie.make_automaton()

    @property
    def names(self) -> list[str]:
        return [f"list{i}" for i in range(LISTS)] + ["twice", "thrice", "two_entries", "dense", *PATTERNS]

    def found(self, text: str) -> tuple[Counter, int]:
        """Times that each lexicon entry is met at the start of a word, and about how many words there are."""
        low, hits = text.lower(), Counter()
        words: dict[int, tuple[list, Counter]] = {}
        if self.lexicon:
            for end, (n, whole, doses) in self.trie.iter(low):
                if end >= n and low[end - n].isalpha():
                    continue
                word = WORDS.match(low, end - n + 1)
                word = word.group() if word else ""
                if whole is not None and len(word) == n:
                    hits[whole] += 1
                if doses:
                    words.setdefault(id(doses), (doses, Counter()))[1][word] += 1
        for doses, met in words.values():
            for dose, i in doses:
                if len(met) >= dose:
                    hits[i] += sum(met.values())
        return hits, text.count(" ") + 1

    def row(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Votes (0 or 1) and classifier features of a text."""
        hits, n = self.found(text)
        votes = np.zeros(len(self.names))
        for i in hits:
            votes[i % LISTS] = 1
        kinds = {self.lexicon[i][-2:] for i in hits}
        votes[LISTS : LISTS + 4] = "|2" in kinds, "|3" in kinds, len(hits) > 1, 50 * sum(hits.values()) >= n
        for k, p in enumerate(PATTERNS.values()):
            votes[LISTS + 4 + k] = p.search(text) is not None
        x = np.zeros(len(self.lexicon) + len(self.names) + 2)
        for i in hits:
            x[i] = 1
        x[len(self.lexicon) : len(self.lexicon) + len(votes)] = votes
        x[-2], x[-1] = np.log1p(sum(hits.values())), min(1.0, 20 * sum(hits.values()) / n)
        return votes, x


def vote_moments(docs: DataFrame, lexicon: list[str]) -> tuple[int, np.ndarray]:
    """Number of documents and, for each pair of voters, of documents on which both fire, over all of ``docs``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voters = Voters(lexicon)
        m = len(voters.names)
        both, n = np.zeros((m, m)), 0
        for b in batches:
            v = np.array([voters.row(t or "")[0] for t in b["text"]]).reshape(-1, m)
            both, n = both + v.T @ v, n + len(v)
        i, j = np.nonzero(both)
        yield pd.DataFrame({"i": [*i, -1], "j": [*j, -1], "n": [*both[i, j].astype(int), n]})

    m = len(Voters(lexicon).names)
    got = docs.select("text").mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas()
    both = np.zeros((m, m))
    inside = got[got["i"] >= 0]
    both[inside["i"], inside["j"]] = inside["n"]
    return int(got.loc[got["i"] < 0, "n"].sum()), both


def _edges(cov: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Edge of each voter from triplets: cov_ij * cov_ik / cov_jk is its square, of which the median resists odd pairs."""
    out = np.zeros(len(cov))
    for i in range(len(cov)):
        near = [j for j in np.flatnonzero(use[i]) if cov[i, j] > 0]
        squares = [cov[i, j] * cov[i, k] / cov[j, k] for n, j in enumerate(near) for k in near[n + 1 :] if use[j, k] and cov[j, k] > 1e-12]
        out[i] = math.sqrt(np.median(squares) if squares else max((cov[i, j] for j in near), default=0.0))
    return out


def label_model(n: int, both: np.ndarray, prior: float) -> dict:
    """Firing rates of each voter in either class, and the weight left to it by voters it is correlated with."""
    mean = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(mean, mean)
    sd = np.sqrt(np.outer(mean * (1 - mean), mean * (1 - mean))) + 1e-12
    off = ~np.eye(len(both), dtype=bool) & np.outer(mean > 0, mean > 0)
    dependent = np.zeros_like(off)
    for _ in range(2):
        edge = _edges(cov, off & ~dependent)
        # pairs that agree far beyond what the class explains
        excess = np.where(off, (cov - np.outer(edge, edge)) / sd, 0)
        dependent = excess > 0.3
    gap = edge / np.sqrt(prior * (1 - prior))
    a = np.clip(mean + (1 - prior) * gap, 1e-4, 1 - 1e-4)
    b = np.clip(mean - prior * gap, 1e-5, 1 - 1e-4)
    share = 1 / (1 + np.where(dependent, np.clip(excess, 0, 1), 0).sum(axis=1))
    return {"a": a, "b": b, "share": share, "prior": prior}


def posterior(votes: np.ndarray, model: dict) -> np.ndarray:
    a, b = model["a"], model["b"]
    z = np.log(model["prior"] / (1 - model["prior"])) + (votes * np.log(a / b) + (1 - votes) * np.log((1 - a) / (1 - b))) @ model["share"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add ``held_out``, ``score`` (0 to 1, higher is likelier toxic) and ``predicted`` (1 from 0.3 on) to each document.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic.  Only the text enters a
    score; null texts count as empty; labels other than 0 and 1 and repeated label rows
    are ignored; without training rows of both classes every score is the share of
    toxic ones among the labels (0 without any).  Same-named input columns are replaced; repeated rows
    stay repeated and equal texts tie; a very long text is read whole, in memory of a few times
    its size; no documents give none."""
    train = ~is_held_out(F.col("doc_id"))
    known = {r["toxic"]: r["count"] for r in labels.filter(train & F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()}
    out = docs.withColumn("held_out", is_held_out(F.col("doc_id")))
    total = sum(known.values())
    if len(known) < 2:
        rate = float(known.get(1, 0) / total) if total else 0.0
        return out.withColumns({"score": F.lit(rate), "predicted": F.lit(int(rate >= CUT))})
    prior = known[1] / total
    rows = stored(training_rows(docs, labels, "toxic", train, sample_rows).select("doc_id", "text", "y"), "toxicity-sample")
    rows = stored(distinct_rows(rows), "toxicity-rows")
    lexicon = learn_lexicon(rows)
    model = label_model(*vote_moments(docs, lexicon), prior)

    @F.pandas_udf("array<double>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        voters = Voters(lexicon)
        for texts in batches:
            yield pd.Series([np.concatenate(voters.row(t or "")) for t in texts], dtype=object)

    got = rows.select("doc_id", "y", look("text").alias("x")).toPandas().sort_values("doc_id")  # bounded by sample_rows
    if got["y"].nunique() < 2:
        return out.withColumns({"score": F.lit(float(prior)), "predicted": F.lit(int(prior >= CUT))})
    m = len(model["a"])
    x = np.array(got["x"].tolist(), dtype=float)
    y = got["y"].to_numpy()
    soft = posterior(x[:, :m], model)
    with_one = np.hstack([x[:, m:], np.ones((len(x), 1))])
    w = logistic(with_one, soft, np.r_[np.full(x.shape[1] - m, 1e-4), 1e-6])
    # the classifier's margin is put on the scale of the labels; the two classes were drawn to a bound, so they are weighed back
    z = with_one @ w
    weight = np.where(y == 1, prior / max((y == 1).mean(), 1e-9), (1 - prior) / max((y == 0).mean(), 1e-9))
    scale, shift = logistic(np.column_stack((z, np.ones(len(z)))), y, np.array([1e-4, 1e-6]), weight)
    scale = max(scale, 0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        voters = Voters(lexicon)
        for texts in batches:
            f = np.array([voters.row(t or "")[1] for t in texts], dtype=float).reshape(len(texts), len(w) - 1)
            yield pd.Series(1 / (1 + np.exp(-np.clip(scale * (f @ w[:-1] + w[-1]) + shift, -30, 30))))

    return out.withColumn("score", score("text")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
