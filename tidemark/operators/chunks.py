"""Cleaning, chunking, embedding and incremental index bookkeeping."""

from __future__ import annotations

import re
import sys
import uuid
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import vectors as V

# What an embedding service says when its input is too large.
SIZE_ERROR = re.compile(r"\b(?:400|413)\b|length|large", re.IGNORECASE)


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Drop lines over 1000 characters (counted in ``dropped_lines``), remove
    garbage runs and repeats, drop documents left blank."""
    t = F.col(text_col)
    others = [c for c in docs.columns if c != text_col]
    cleaned = T.clean_garbage(T.drop_long_lines(t))
    # the blank test runs on the computed value inside one generator, so the
    # optimizer cannot push it below the projection and clean every text twice
    kept = F.explode(F.filter(F.array(cleaned), lambda x: ~T.is_blank(x)))
    return docs.select(*others, T.count_long_lines(t).alias("dropped_lines"), kept.alias(text_col))


def chunk_tokens(docs: DataFrame, key_col: str = "file_path", text_col: str = "text",
                 size: int = T.CHUNK_TOKENS, overlap: int = T.CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk: windows of ``size`` whitespace tokens overlapping by
    ``overlap``; ``chunk_id = key#pos``.  Narrow (no shuffle): every document is
    chunked where it is read."""
    keep = [c for c in docs.columns if c != text_col]
    # tokens are a column of their own: referenced twice (count and windows), so
    # the optimizer keeps one split per document instead of one per window
    toks = docs.select(*keep, T.tokens(F.col(text_col)).alias("_toks"))
    exploded = toks.select(*keep, F.posexplode(T.token_windows(F.col("_toks"), size, overlap)).alias("pos", "text"))
    return exploded.withColumn("chunk_id", F.concat(F.col(key_col).cast("string"), F.lit("#"), F.col("pos").cast("string")))


def embed_default(chunks: DataFrame, text_col: str = "text", out_col: str = "embedding",
                  dim: int = V.DEFAULT_DIM) -> DataFrame:
    """Model-free embedding: hashed term counts (one vectorised pandas step)."""
    return chunks.withColumn(out_col, V.hashed_term_vector(F.col(text_col), dim))


class CountMismatch(RuntimeError):
    """The embedding function returned another number of vectors than it got texts."""


def is_size_error(err: Exception) -> bool:
    """Whether an error of the embedding function says that its input was too large."""
    return not isinstance(err, CountMismatch) and SIZE_ERROR.search(str(err)) is not None


def _halves(text: str) -> list[str]:
    """A text in two parts, cut at the white space nearest to its middle if there is any."""
    mid = len(text) // 2
    cut = max(text.rfind(" ", 1, mid + 1), text.rfind("\n", 1, mid + 1))
    return [text[:cut], text[cut:]] if cut > 0 else [text[:mid], text[mid:]]


def adaptive_embed(fn: Callable[[list[str]], Sequence[Sequence[float]]], texts: list[str]) -> list[list[float]]:
    """Vectors of ``texts``, all of each text embedded.

    Works through a list of batches.  A batch that ``fn`` finds too large goes back in
    two; a single text that is too large goes back as two parts, and its vector is the
    mean of its parts weighed by their lengths.  Other errors propagate, as does a size
    error on a single character."""
    parts = [(i, t) for i, t in enumerate(texts)]
    sums: list[list[float] | None] = [None] * len(texts)
    waiting = [parts] if parts else []
    while waiting:
        batch = waiting.pop()
        try:
            got = list(fn([t for _, t in batch]))
            if len(got) != len(batch):
                raise CountMismatch(f"{len(got)} vectors for {len(batch)} texts")
        except Exception as e:  # noqa: BLE001 - user function
            if not is_size_error(e) or (len(batch) == 1 and len(batch[0][1]) < 2):
                raise
            if len(batch) == 1:
                waiting += [[(batch[0][0], t)] for t in _halves(batch[0][1])]
            else:
                waiting += [batch[: len(batch) // 2], batch[len(batch) // 2 :]]
            continue
        for (i, text), vector in zip(batch, got):
            share = len(text) / len(texts[i]) if texts[i] else 1.0
            own = [share * float(x) for x in vector]
            sums[i] = own if sums[i] is None else [a + b for a, b in zip(sums[i], own)]
    return sums  # type: ignore[return-value]


def once_a_worker(factory: Callable[[], Callable]) -> Callable[[], Callable]:
    """A function that gives what ``factory()`` made, which runs once in each Python worker whatever the number of its tasks.

    The model stays beside the interpreter's own state: a module's globals may be shipped with every task."""
    key = uuid.uuid4().hex

    def model() -> Callable:
        made = vars(sys).setdefault("_tidemark_models", {})
        if key not in made:
            made[key] = factory()
        return made[key]

    return model


def embed_with(chunks: DataFrame, fn: Callable[[list[str]], Sequence[Sequence[float]]] | None = None,
               id_col: str = "chunk_id", text_col: str = "text", group_col: str = "file_path",
               out_col: str = "embedding", batch_rows: int = 256,
               factory: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]] | None = None, profile=None) -> DataFrame:
    """Embed with a user function on Arrow batches (``mapInPandas``).

    ``fn(list[str]) -> list[vector]`` is called per batch on the executors; a model that
    is costly to load comes from ``factory()`` instead, which runs once a Python worker.
    ``profile`` is the ``pyspark.resource.ResourceProfile`` of the embedding stage (such as one
    that asks for a GPU), for clusters that allocate executors dynamically.
    Size errors are handled by :func:`adaptive_embed`.  A chunk that
    still fails gets ``error`` set; :func:`drop_failed_documents` then removes
    the whole document so the next incremental run retries it.
    """
    if (fn is None) == (factory is None):
        raise ValueError("give either fn or factory")
    model = once_a_worker(factory) if factory is not None else lambda: fn

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = model()
        for pdf in it:
            for start in range(0, len(pdf), batch_rows):
                part = pdf.iloc[start:start + batch_rows]
                texts = part[text_col].fillna("").tolist()
                try:
                    vecs, errs = adaptive_embed(embed, texts), [None] * len(texts)
                except Exception:  # noqa: BLE001 - isolate failures per text
                    vecs, errs = [], []
                    for t in texts:
                        try:
                            vecs.append(adaptive_embed(embed, [t])[0])
                            errs.append(None)
                        except Exception as e:  # noqa: BLE001
                            vecs.append(None)
                            errs.append(str(e)[:500])
                yield pd.DataFrame({id_col: part[id_col].values, group_col: part[group_col].values,
                                    out_col: vecs, "error": errs})

    schema = f"`{id_col}` string, `{group_col}` string, `{out_col}` array<float>, error string"
    return chunks.select(id_col, group_col, text_col).mapInPandas(run, schema, profile=profile)


def drop_failed_documents(chunks: DataFrame, vectors: DataFrame, id_col: str = "chunk_id",
                          group_col: str = "file_path", out_col: str = "embedding") -> DataFrame:
    """Attach vectors; any failed chunk removes its whole document."""
    failed = vectors.where(F.col("error").isNotNull()).select(group_col).distinct()
    ok = vectors.where(F.col("error").isNull()).select(id_col, out_col)
    return chunks.join(ok, id_col).join(failed, group_col, "left_anti")


def with_content_key(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``content_md5`` so an incremental run can key on path + content."""
    return docs.withColumn("content_md5", F.md5(F.col(text_col)))


def not_indexed(docs: DataFrame, chunks_table: DataFrame | None, key_col: str | list[str] = "file_path") -> DataFrame:
    """Documents whose key has no stored chunk yet (failed ones are retried).

    The default key is the path (changed content is not re-indexed, as in the
    reference); ``key_col=["file_path", "content_md5"]`` re-indexes changed files.
    """
    if chunks_table is None:
        return docs
    keys = [key_col] if isinstance(key_col, str) else list(key_col)
    done = chunks_table.select(*keys).distinct()
    return docs.join(done, keys, "left_anti")


def index_summary(docs: DataFrame, new_chunks: DataFrame, chunks_table: DataFrame | None,
                  key_col: str = "file_path") -> DataFrame:
    """chunks, files indexed, files skipped (no chunk), files already indexed — one row."""
    done = (chunks_table.select(key_col).distinct().withColumn("_done", F.lit(True))
            if chunks_table is not None else None)
    per_doc = new_chunks.groupBy(key_col).agg(F.count("*").alias("_n"))
    d = docs.select(key_col)
    if done is not None:
        d = d.join(done, key_col, "left")
    else:
        d = d.withColumn("_done", F.lit(None).cast("boolean"))
    d = d.join(per_doc, key_col, "left")
    return d.agg(
        F.coalesce(F.sum(F.when(F.col("_done").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("chunks"),
        F.count_if(F.col("_done").isNull() & F.col("_n").isNotNull()).alias("files_indexed"),
        F.count_if(F.col("_done").isNull() & F.col("_n").isNull()).alias("files_skipped"),
        F.count_if(F.col("_done").isNotNull()).alias("files_already_indexed"),
    )


def write_chunks(chunks: DataFrame, path: str, mode: str = "append") -> None:
    """Store chunks partitioned by domain; ``overwrite`` replaces only the domains
    present (dynamic partition overwrite), ``append`` adds."""
    # rebalancing splits a huge domain into as many tasks as its size asks for
    (chunks.hint("rebalance", F.col("domain")).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy("domain").parquet(path))


# Fixed value: a sentence ends at a line break and where white space follows one of these.
SENTENCE_MARKS = ".!?"


def sentence_pieces(text: Column, size: int = T.CHUNK_TOKENS, overlap: int = T.CHUNK_OVERLAP) -> Column:
    """Sentences of a text as token arrays; one of more than ``size`` tokens is cut into windows."""
    lines = F.split(F.regexp_replace(text, f"(?U)([{SENTENCE_MARKS}]){T.FAST_WS}+", "$1\n"), "\n")
    sentences = F.filter(F.transform(lines, T.tokens), lambda s: F.size(s) > 0)
    windows = lambda s: F.transform(T.chunk_starts(F.size(s), size, overlap), lambda at: F.slice(s, at + 1, size))
    return F.flatten(F.transform(sentences, lambda s: F.when(F.size(s) <= size, F.array(s)).otherwise(windows(s))))


def _sentence_steps(pieces: DataFrame, size: int, overlap: int) -> DataFrame:
    """Of each document the arrays ``until`` and ``next``: where a chunk that starts at a sentence ends, and where the one after it starts.

    With prefix sums of the sentence lengths both are searches for the next sum, done
    by range frames; a last entry stands for the end of the document."""
    sums = pieces.select("__doc", F.posexplode(F.concat(F.transform("__pieces", F.size), F.array(F.lit(0)))).alias("i", "n"))
    by_place = Window.partitionBy("__doc").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__doc", "i", F.coalesce(F.sum("n").over(by_place), F.lit(0)).alias("at"))
    by_sum = Window.partitionBy("__doc").orderBy("at")
    fits, beyond = by_sum.rangeBetween(0, size), by_sum.rangeBetween(size + 1, Window.unboundedFollowing)
    ends = sums.select(
        "__doc", "i", "at", F.max("i").over(fits).alias("until"), F.max("at").over(fits).alias("until_at"), F.min("at").over(beyond).alias("after"))
    # the next chunk takes up trailing sentences of at most ``overlap`` tokens that leave room for the first new one
    earliest = F.greatest(F.col("until_at") - overlap, F.col("after") - size)
    asked = ends.select("__doc", F.when(F.col("after").isNull(), F.col("until_at")).otherwise(earliest).alias("at"), F.col("i").alias("of"), "until", F.lit(None).cast("int").alias("i"))
    every = asked.unionByName(sums.select("__doc", "at", F.lit(None).cast("int").alias("of"), F.lit(None).cast("int").alias("until"), "i"))
    following = Window.partitionBy("__doc").orderBy("at").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    steps = every.withColumn("next", F.min("i").over(following)).filter("of is not null")
    told = F.array_sort(F.collect_list(F.struct("of", "until", "next")))
    return steps.groupBy("__doc").agg(told.alias("t")).select("__doc", F.col("t.until").alias("until"), F.col("t.next").alias("next"))


def chunk_sentences(docs: DataFrame, key_col: str = "file_path", text_col: str = "text",
                    size: int = T.CHUNK_TOKENS, overlap: int = T.CHUNK_OVERLAP) -> DataFrame:
    """Sentence-aware chunks (one row each, ``chunk_id = key#pos``): whole sentences up to ``size`` tokens.

    The next chunk starts with the last one's trailing sentences that fit in ``overlap``
    tokens, fewer of them where the first new sentence would not fit behind them; a sentence
    longer than ``size`` is cut into windows.  For every sentence the start of the
    chunk after one that would start there is found at once; the starts that are reached from
    the first sentence are then collected by pointer doubling, in as many steps as the
    longest document needs.  Texts without words have no chunks."""
    from tidemark.session import materialise

    keep = [c for c in docs.columns if c != text_col]
    pieces = docs.withColumn("__doc", F.monotonically_increasing_id()).select(*keep, "__doc", sentence_pieces(F.col(text_col), size, overlap).alias("__pieces"))
    pieces = materialise(pieces.filter(F.size("__pieces") > 0), "sentence-pieces")
    longest = pieces.agg(F.max(F.size("__pieces"))).first()[0] or 0
    reach = _sentence_steps(pieces, size, overlap).withColumn("jump", F.col("next")).withColumn("starts", F.array(F.lit(0)))
    for _ in range(longest.bit_length()):
        reach = reach.withColumn("starts", F.array_union("starts", F.transform("starts", lambda s: F.element_at("jump", s + 1))))
        reach = reach.withColumn("jump", F.transform("jump", lambda s: F.element_at("jump", s + 1)))
    # the end of the document is reached too
    starts = F.array_sort(F.filter("starts", lambda s: s < F.size("until") - 1))
    found = reach.select("__doc", "until", F.posexplode(starts).alias("pos", "__from"))
    taken = F.slice("__pieces", F.col("__from") + 1, F.element_at("until", F.col("__from") + 1) - F.col("__from"))
    out = pieces.join(found, "__doc").select(*keep, "pos", F.array_join(F.flatten(taken), " ").alias("text"))
    return out.withColumn("chunk_id", F.concat(F.col(key_col).cast("string"), F.lit("#"), F.col("pos").cast("string")))
