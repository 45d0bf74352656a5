"""Alignment of two tokenizers over a corpus, with counts of linked id pairs.

Texts are encoded whole by both.  The byte offsets where tokens of both end cut the tokens of
a text into groups; all pairs of a group are linked.  The texts of a slice are aligned
together, by arrays of their tokens' ends.

Counts of id pairs live in dense vectors.  A first pass encodes the documents, keeps their ids
and finds the pairs of each task with the number of its documents that hold them.  The
distinct pairs are numbered by a minimal perfect hash, and the tasks' counts are laid into
vectors by that number and added up by a tree.  A second pass aligns the kept ids again
and looks the counts up, comparing the key kept at each number."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, in_slices, stored, vocabulary
from .counters import WIDTH, added, sliced, tree_sum
from .packing import BYTE_LETTERS
from .perfect_hash import PerfectHash

#: Pairs whose counts are held at once; beyond it the pairs are counted and looked up in rounds, by ranges of their first id.
ROUND = 1 << 21
#: Characters aligned at once, and links of a group from which its ids are counted before they are paired.
SLICE, LARGE = 1 << 19, 1 << 12

U = np.uint64
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _table(of_id: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids behind each other, where those of each begin, and how many they are."""
    sizes = np.array([len(t) for t in of_id], dtype=np.int64)
    return np.frombuffer(b"".join(of_id), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


class Aligner:
    """Ids of texts by a byte-level file of the tokenizers library (A) and a sentencepiece model (B), and the bytes of each id."""

    def __init__(self, path_a: str | None, path_b: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece

        self.path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path("piece_bpe_32k.model"))
        with open(self.path_a, encoding="utf-8") as f:
            file = json.load(f)
        letters = {c: b for b, c in enumerate(BYTE_LETTERS)}
        vocab = file["model"]["vocab"]
        of_token = {t: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in vocab}
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.bytes_a[i] = of_token[t]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.table_a, self.table_b = _table(self.bytes_a), _table(self.bytes_b)
        self.encode_a = self._ranked(file, vocab, of_token) or self._whole()

    def ids(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by A and by B; none for empty texts and those that either side doesn't give back byte for byte."""
        some = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in some]
        a, b = self.encode_a(spaced), self.b.encode([texts[k] for k in some], num_threads=1)
        raw = [t.encode() for t in spaced]
        whole = not some or self.gives_back(raw, a, b)
        out = [np.zeros(0, np.uint32)] * len(texts), [np.zeros(0, np.uint32)] * len(texts)
        for k, r, x, y in zip(some, raw, a, b):
            if whole or self.gives_back([r], [x], [y]):
                out[0][k], out[1][k] = x, np.array(y, dtype=np.uint32)
        return out

    def gives_back(self, raw: list[bytes], a: list[np.ndarray], b: list[list[int]]) -> bool:
        """Whether the ids of each text, of both sides, are its bytes."""
        whole, ends = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(r) for r in raw])
        for ids, (table, start, sizes) in ((a, self.table_a), (b, self.table_b)):
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64) if ids is b else np.concatenate(ids)
            at, n = np.cumsum([len(i) for i in ids]) - 1, sizes[flat]
            until = np.cumsum(n)
            if (at < 0).any() or (until[at] != ends).any():
                return False
            place = np.repeat(start[flat] - (until - n), n) + np.arange(len(whole))
            if (table[place] != whole).any():
                return False
        return True

    @staticmethod
    def _ranked(file: dict, vocab: dict, of_token: dict):
        """Encoding by ranks, several times faster, where the file's merges are in the order of their ids and it cuts words in the usual way."""
        import public_tokenizers
        import tiktoken

        cut = file.get("pre_tokenizer") or {}
        merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", ""), -1) for m in file["model"]["merges"]]
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not file.get("normalizer")
        if not usual or merged != sorted(merged):
            return None
        special = {t["content"] for t in file.get("added_tokens", [])}
        ranks = {of_token[t]: i for t, i in vocab.items() if t not in special}
        encoding = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [encoding.encode_to_numpy(t) for t in texts]

    def _whole(self):
        """Encoding by the file itself."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path_a)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        return lambda texts: [np.array(e.ids, dtype=np.uint32) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _aligner(paths: tuple[str | None, str | None]) -> Aligner:
    return vocabulary(("alignment", paths), lambda: Aligner(*paths))


def _width(path_b: str | None) -> int:
    """Number of ids of B."""
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path("piece_bpe_32k.model")).get_piece_size()


class Slice:
    """The aligned tokens of some texts: their groups, and for each link the text and the number of its different pair."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], aligner: Aligner):
        """Of the ids of each text by A and by B; a text without tokens has none of either."""
        self.n, sizes = len(a), [np.array([len(x) for x in own], dtype=np.int64) for own in (a, b)]
        # all texts behind each other: both sides end together at the end of each text
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *own]).astype(np.int64) for own in (a, b))
        self.doc_a, self.doc_b = (np.repeat(np.arange(self.n), own) for own in sizes)
        end_a, end_b = np.cumsum(aligner.table_a[2][self.a]), np.cumsum(aligner.table_b[2][self.b])
        at = np.searchsorted(end_b, end_a)
        both_a = end_b[at] == end_a if len(end_a) else np.zeros(0, dtype=bool)
        both_b = np.zeros(len(end_b), dtype=bool)
        both_b[at[both_a]] = True
        group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        self.groups = int(both_a.sum())
        self.size_a, self.size_b = np.bincount(group_a, minlength=self.groups), np.bincount(group_b, minlength=self.groups)
        self.from_a, self.from_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        self.doc = self.doc_a[self.from_a]
        self._pair(len(aligner.bytes_b))

    @classmethod
    def of(cls, texts: list[str | None], aligner: Aligner) -> Slice:
        return cls(*aligner.ids(texts), aligner)

    def _pair(self, width: int) -> None:
        """``pairs``: the different ones; of each entry ``which`` pair it is, its ``text`` and how many ``links`` it stands for."""
        n = self.size_a * self.size_b
        small = np.flatnonzero(n < LARGE)
        ends = np.cumsum(n[small])
        group = np.repeat(small, n[small])
        inside = np.arange(len(group)) - np.repeat(ends - n[small], n[small])
        pair = self.a[self.from_a[group] + inside // self.size_b[group]] * width + self.b[self.from_b[group] + inside % self.size_b[group]]
        of, links = [self.doc[group]], [np.ones(len(group), dtype=np.int64)]
        pairs = [pair]
        for g in np.flatnonzero(n >= LARGE):  # ids of a large group are counted first
            x, many_x = np.unique(self.a[self.from_a[g] : self.from_a[g] + self.size_a[g]], return_counts=True)
            y, many_y = np.unique(self.b[self.from_b[g] : self.from_b[g] + self.size_b[g]], return_counts=True)
            pairs.append((x[:, None] * width + y).ravel())
            links.append((many_x[:, None] * many_y).ravel())
            of.append(np.full(len(pairs[-1]), self.doc[g]))
        self.text, self.links = np.concatenate(of), np.concatenate(links)
        different, self.which = np.unique(np.concatenate(pairs), return_inverse=True)
        self.pairs = different.astype(U)

    def total(self, of: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Exact sums of numbers by text."""
        out = np.zeros(self.n, dtype=np.int64)
        np.add.at(out, of, number)
        return out

    def counts(self) -> dict[str, np.ndarray]:
        tokens = (np.bincount(own, minlength=self.n) for own in (self.doc_a, self.doc_b, self.doc))
        return dict(zip(COLUMNS, [*tokens, self.total(self.doc, self.size_a * self.size_b)]))

    def documents(self) -> np.ndarray:
        """How many texts hold each different pair."""
        held = np.unique(self.text * len(self.pairs) + self.which) % max(len(self.pairs), 1)
        return np.bincount(held, minlength=len(self.pairs))

    def shown(self) -> list[str]:
        """Of each text its groups as ``a1,a2|b1;a3|b2,b3``."""
        parts = np.empty(self.groups, dtype=object)
        alone = (self.size_a == 1) & (self.size_b == 1)
        a, b = self.a[self.from_a[alone]], self.b[self.from_b[alone]]
        # groups of two single tokens are few different ones
        pair, which = np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)
        own = np.zeros(len(pair), dtype=np.int64)
        own[which] = np.arange(len(a))
        parts[alone] = np.array([f"{x}|{y}" for x, y in zip(a[own].tolist(), b[own].tolist())], dtype=object)[which]
        a, b, more = self.a.tolist(), self.b.tolist(), np.flatnonzero(~alone)
        places = (own[more].tolist() for own in (self.from_a, self.size_a, self.from_b, self.size_b))
        parts[more] = np.array([",".join(map(str, a[i : i + n])) + "|" + ",".join(map(str, b[j : j + m])) for i, n, j, m in zip(*places)], dtype=object)
        cut = np.searchsorted(self.doc, np.arange(self.n + 1))
        return [";".join(parts[i:j]) for i, j in zip(cut[:-1], cut[1:])]


def kept_tokens(texts: DataFrame, paths: tuple[str | None, str | None], most: int) -> DataFrame:
    """Rows of two kinds, written once.  Of each text (doc_id, a, b): its ids as packed arrays.  Of each task (pairs, counts): the
    different pairs, a * size of B + b, in order, and how many documents of the task hold each.

    A task sends pairs whenever it holds over ``most``, so a pair may come several times."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, sums = np.zeros(0, U), np.zeros(0, np.int64)

        def sent() -> pd.DataFrame:
            return pd.DataFrame({"doc_id": [None], "a": [None], "b": [None], "pairs": [keys.astype("<u8").tobytes()], "counts": [sums.astype("<u4").tobytes()]})

        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in in_slices(texts, SLICE):
                aligner = _aligner(paths)
                a, b = aligner.ids(texts[lo:hi])
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[lo:hi].to_numpy(), "a": [_packed(x, aligner.bytes_a) for x in a], "b": [_packed(x, aligner.bytes_b) for x in b],
                    "pairs": None, "counts": None})
                s = Slice(a, b, aligner)
                both, which = np.unique(np.concatenate((keys, s.pairs)), return_inverse=True)
                sums = np.bincount(which, np.concatenate((sums, s.documents())), len(both)).astype(np.int64)
                keys = both
                if len(keys) > most:
                    yield sent()
                    keys, sums = keys[:0], sums[:0]
        yield sent()
        give_back()

    kept = texts.select("doc_id", "text").mapInPandas(look, "doc_id string, a binary, b binary, pairs binary, counts binary")
    return stored(kept.withColumn("row", F.monotonically_increasing_id()), "tokens")


def _width_of(vocabulary: list) -> str:
    return "<u2" if len(vocabulary) <= 1 << 16 else "<u4"


def _packed(ids: np.ndarray, vocabulary: list) -> bytes:
    return ids.astype(_width_of(vocabulary)).tobytes()


def distinct_pairs(counts: DataFrame) -> DataFrame:
    """(pair): the different pairs of all tasks."""

    def out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for raw in b["pairs"]:
                yield pd.DataFrame({"pair": np.frombuffer(raw, "<i8")})

    return stored(counts.select("pairs").mapInPandas(out, "pair long").distinct(), "distinct-pairs")


def rounds_of(pairs: DataFrame, width: int, most: int = ROUND) -> list[int]:
    """First ids A of the rounds: neighbouring ids with at most ``most`` pairs together, or one id."""
    sizes = pairs.groupBy(F.expr(f"pair div {width}").alias("a")).count().orderBy("a").collect()  # one row for each id of vocabulary A at most
    starts, held = [0], 0
    for r in sizes:
        if held and held + r["count"] > most:
            starts.append(r["a"])
            held = 0
        held += r["count"]
    return starts


def _hashes(pairs: DataFrame, starts: list[int], width: int) -> DataFrame:
    """(round, hash): the perfect hash of the pairs of each round, built by a task each (``ROUND`` bounds a round)."""
    number = F.size(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= F.expr(f"pair div {width}"))) - 1

    def build(batch: pd.DataFrame) -> pd.DataFrame:
        made = PerfectHash(np.sort(batch["pair"].to_numpy()).astype(U))
        return pd.DataFrame({"round": [batch["round"].iloc[0]], "hash": [made.to_bytes()]})

    return stored(pairs.withColumn("round", number).groupBy("round").applyInPandas(build, "round int, hash binary"), "pair-hashes")


def _summed(counts: DataFrame, made: PerfectHash) -> np.ndarray:
    """How many documents hold each numbered pair: the tasks' counts laid into vectors by number, added up by a tree."""
    shared = counts.sparkSession.sparkContext.broadcast(made)  # bounded by ROUND

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(shared.value), dtype=np.uint64)
        for b in batches:
            for raw, n in zip(b["pairs"], b["counts"]):
                at = shared.value.find(np.frombuffer(raw, "<u8"))
                total[at[at >= 0]] += np.frombuffer(n, "<u4")[at >= 0]  # a pair is once in each row
        rows = list(sliced(total))
        yield pd.DataFrame({"slice": [k for k, _ in rows], "counts": [c for _, c in rows]})
        del total, rows
        give_back()

    out = np.zeros(len(made), dtype=np.int64)
    for r in tree_sum(counts.mapInPandas(lay, "slice int, counts binary"), "pair-counts").collect():  # ROUND numbers at most
        part = out[r["slice"] * WIDTH : (r["slice"] + 1) * WIDTH]
        part += added([r["counts"]])[: len(part)].astype(np.int64)
    shared.destroy()
    return out


def pair_counts(docs: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None, most: int = ROUND) -> DataFrame:
    """(a, b, documents): how many documents link each pair of ids."""
    texts, width, out = docs.select(F.lit(None).cast("string").alias("doc_id"), F.col(text_col).alias("text")), _width(path_b), None
    for made, counts, _ in _rounds(kept_tokens(texts, (path_a, path_b), most), width, most)[1]:
        a, b = np.divmod(made.keys.astype(np.int64), width)
        own = docs.sparkSession.createDataFrame(pd.DataFrame({"a": a, "b": b, "documents": counts}), "a long, b long, documents long")
        out = own if out is None else out.unionByName(own)
    return out


def _rounds(kept: DataFrame, width: int, most: int) -> tuple[int, Iterator[tuple[PerfectHash, np.ndarray, np.ndarray]]]:
    """The number of rounds, and of each (hash, documents of each pair, whether no pair of the same id A has more)."""
    of_tasks = kept.filter("pairs is not null").select("pairs", "counts")
    pairs = distinct_pairs(of_tasks)
    starts = rounds_of(pairs, width, most)
    hashes = _hashes(pairs, starts, width)

    def each() -> Iterator[tuple[PerfectHash, np.ndarray, np.ndarray]]:
        for k in range(len(starts)):
            blob = hashes.filter(F.col("round") == k).select("hash").collect()
            made = PerfectHash.from_bytes(blob[0]["hash"]) if blob else PerfectHash(np.zeros(0, U))
            counts = _summed(of_tasks, made)
            a = (made.keys // U(width)).astype(np.int64)
            best = np.zeros(int(a.max(initial=0)) + 1, dtype=np.int64)
            np.maximum.at(best, a, counts)  # all pairs of an id are in one round
            yield made, counts, counts == best[a]

    return len(starts), each()


def align_documents(
    docs: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None, most: int = ROUND,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups`` of each row of ``docs``.

    A encodes a space and the text, B the text; ``groups`` lists their ids as
    ``a1,a2|b1;a3|b2,b3``.  n_best counts links whose pair no other pair of the same id A
    exceeds in documents; count_sum adds up the documents of each link's pair.  Each row is a
    document, also a repeated one or one without doc_id.  Null and empty texts, and texts
    that either tokenizer doesn't give back byte for byte, have no tokens: zeros and an
    empty string.  More columns are ignored; no documents give no rows.  A very long text
    is aligned in one task with memory of some fifty times its size."""
    paths = (path_a, path_b)
    kind = docs.schema["doc_id"].dataType
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    kept = kept_tokens(texts, paths, most)
    rounds, each = _rounds(kept, _width(path_b), most)
    rows = kept.filter("pairs is null").select("row", "doc_id", "a", "b")
    out = more = None
    for made, counts, best in each:
        held = docs.sparkSession.sparkContext.broadcast((made, counts, best))  # bounded by ROUND
        found = rows.mapInPandas(_looked_up(held, paths, first=out is None), _schema(first=out is None))
        if rounds > 1:
            found = stored(found, "aligned")
            held.destroy()
        if out is None:
            out = found
        else:
            more = found if more is None else more.unionByName(found)
    if more is not None:
        more = more.groupBy("row").agg(F.sum("n_best").alias("best_too"), F.sum("count_sum").alias("sum_too"))
        out = out.join(more, "row").withColumns({"n_best": F.col("n_best") + F.col("best_too"), "count_sum": F.col("count_sum") + F.col("sum_too")})
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), *COLUMNS, "groups")


def _schema(first: bool) -> str:
    return "row long, doc_id string, " + ", ".join(f"{c} long" for c in COLUMNS) + ", groups string" if first else "row long, n_best long, count_sum long"


def _looked_up(held, paths: tuple, first: bool):
    """The task of the last pass: counts of the links of each text; the first round also tells the tokens and groups."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, counts, best = held.value
        for batch in batches:
            for lo, hi in in_slices(batch["a"].tolist(), SLICE):
                aligner, own = _aligner(paths), batch.iloc[lo:hi]
                s = Slice(*([np.frombuffer(x, _width_of(v)) for x in own[c]] for c, v in (("a", aligner.bytes_a), ("b", aligner.bytes_b))), aligner)
                at = made.find(s.pairs)
                documents = np.where(at >= 0, counts[at], 0) if len(counts) else np.zeros(len(at), np.int64)
                first_of_a = np.where(at >= 0, best[at], False) if len(best) else np.zeros(len(at), bool)
                out = {"row": own["row"].to_numpy()}
                if first:
                    out |= {"doc_id": own["doc_id"].to_numpy(), **s.counts()}
                out["n_best"] = s.total(s.text, s.links * first_of_a[s.which])
                out["count_sum"] = s.total(s.text, s.links * documents[s.which])
                if first:
                    out["groups"] = s.shown()
                yield pd.DataFrame(out)
        give_back()

    return look
