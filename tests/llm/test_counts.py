"""Mixing, token alignment and periodic runs against plain versions of their rules."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import counters, mixing, periodic_runs, token_alignment
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.queries import QUERIES

ODD = [
    None, "", " ", "   ", "a  b", " lead", "trail ", "two  \n lines\n\n here", "tab\tand \u00a0 nbsp", "x\u2581y", "caf\u00e9 \u4e2d\u6587 \u0e44\u0e17\u0e22",
    "<s> </s> <unk> <0x41> <|endoftext|>", "a<|endoftext|>b", "it's we'll 12345 !!! ...", "\u200b \ufeff \u180e x", "\x1c \x85 a", "e\u0301 \ufb01n \u212b",
    "\U0001f600 \U0001f469\u200d\U0001f4bb", "same words same words", "same words same words", "\x00 nul", "http://a.b/c?d=e&f=%20",
]


# --- mixing

def plain_mix(rows, weights=(5, 2, 1), share=1.5, passes=2):
    """(target, source size) of each source by sharing the excess again and again."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = Fraction(share) * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(passes * sizes[s] for s in full)
        target = {s: Fraction(passes * sizes[s]) for s in full} | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > passes * sizes[s]}
        if not over:
            return {s: (float(target[s]), sizes[s]) for s in names}
        full |= over


def mix_rows(seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 3, 40, 700]))), rng.choice(["a", "b", "b", "b", "c", "\U0001f600", "\uffee", None])) for i in range(150)]
    return rows + [(900, None, "b"), (None, "no id here", "a"), (901, "x y", "tiny"), (901, "x y", "tiny"), (902, "word " * 30000, "c"), (903, None, "empty")]


def test_mix_meets_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).repartition(5)
    got = mixing.taken_words(df).collect()
    want = plain_mix(rows)
    source = {i: s for i, _, s in rows}
    assert len(got) == len(rows) and Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    taken = defaultdict(int)
    for r in got:
        target, size = want[source[r.doc_id]]
        assert abs(r.target - target) < 1e-6 * max(1, target) and r.source_size == size and 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 1 for s, (t, _) in want.items())
    again = mixing.taken_words(df.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.taken_words(df.limit(0)).count() == 0
    none = mixing.taken_words(df.withColumn("text", F.lit(None).cast("string"))).collect()
    assert len(none) == len(rows) and all((r.size, r.taken, r.target) == (0, 0, 0.0) for r in none)


def test_schedule_spreads_sources(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    told, pieces = mixing.mix(df, block=64)
    got = sorted(pieces.collect(), key=lambda r: (r.slot, r.offset))
    used = defaultdict(int)
    for r in got:  # each slot is filled from 0 without gaps
        assert r.offset == used[r.slot] and r.length > 0
        used[r.slot] += r.length
    assert sorted(used) == list(range(len(used))) and max(used.values()) == 64
    source = {r.row: r.source for r in told.collect()}
    by_slot = {r.slot: source[r.row] for r in got}
    order = [by_slot[k] for k in range(len(by_slot))]
    share = Counter(order)
    for name, n in share.items():  # every prefix holds a source in nearly its share
        seen = np.cumsum([s == name for s in order])
        assert np.abs(seen - n / len(order) * np.arange(1, len(order) + 1)).max() < 8
    texts = {r.doc_id: r.text for r in df.filter("doc_id is not null").collect()}
    spans = defaultdict(list)
    for r in got:
        spans[r.row].append((r.start, r.start + r.length, r.doc_id))
    for own in spans.values():
        if own[0][2] is not None:
            n = len((texts[own[0][2]] or "").split())
            cover = Counter(k for a, b, _ in own for k in range(a, b))
            assert set(cover) <= set(range(n)) and max(cover.values()) <= 2


def test_points_are_the_golden_ratio_sequence(spark):
    slots = [0, 1, 2, 3, 12345, 2**20 - 1, 2**20, 2**33 + 7, 2**50 + 11]
    df = spark.createDataFrame([(s,) for s in slots], "id long").select(mixing.point(F.col("id")).alias("p"))
    assert [r.p for r in df.collect()] == [s * mixing.STEP % 2**mixing.BITS for s in slots]


# --- counters and hashing

def test_perfect_hash_numbers_keys():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 70_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        made = PerfectHash(keys)
        assert sorted(made.find(keys)) == list(range(len(keys))) and (made.keys[made.find(keys)] == keys).all()
        assert (made.find(keys + np.uint64(2**63)) == -1).all()


def test_tree_sum_adds_all_pieces(spark):
    rows = [(k % 3, counters.packed(np.full(10, k, dtype=np.uint32))) for k in range(300)]
    df = spark.createDataFrame(rows, "slice int, counts binary").repartition(90)
    got = {r.slice: counters.added([r.counts], 10) for r in counters.tree_sum(df, "sum", 10, fan=4).collect()}
    assert {k: v.tolist() for k, v in got.items()} == {s: [sum(k for k in range(300) if k % 3 == s)] * 10 for s in range(3)}
    assert counters.tree_sum(df.limit(0), "sum", 10).count() == 0


# --- token alignment

WHOLE: dict = {}


@pytest.fixture(scope="module")
def tokenizers_():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def plain_alignment(texts, tokenizers_):
    """Per text the counts and groups of the contract, from whole texts and fresh tokenizers."""
    a, b = tokenizers_
    back = {c: x for x, c in enumerate(token_alignment.BYTE_LETTERS)}

    def groups(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode() for i in ids_b]
        if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            return None
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        both, out = sorted(set(ends_a) & set(ends_b)), []
        for lo, hi in zip([0, *both], both):
            out.append(([i for i, e in zip(ids_a, ends_a) if lo < e <= hi], [i for i, e in zip(ids_b, ends_b) if lo < e <= hi]))
        return out

    found = [groups(t) for t in texts]
    count = Counter(p for g in found if g for p in {(x, y) for ga, gb in g for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for g in found:
        links = [(x, y) for ga, gb in g or [] for x in ga for y in gb]
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g or [])
        rows.append((
            sum(len(ga) for ga, _ in g or []), sum(len(gb) for _, gb in g or []), len(g or []), len(links),
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), shown))
    return rows, count


def test_alignment_equals_plain_version(spark, sf, tokenizers_):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()] + ["\u4e2d\u6587 " * 3000 + "z" * 5000]
    want, count = plain_alignment(texts, tokenizers_)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, groups string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.align_documents(df).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] == 0 for w in want) == 3  # null, empty, the piece vocabulary's own space sign
    # in rounds of few pairs the result is the same
    rounds = {r.doc_id: tuple(r)[1:] for r in token_alignment.align_documents(df, most=len(count) // 3).collect()}
    assert rounds == got
    pairs = {(r.a, r.b): r.documents for r in token_alignment.pair_counts(df, most=len(count) // 2).collect()}
    assert pairs == dict(count)
    assert token_alignment.align_documents(df.limit(0)).count() == 0
    lone = token_alignment.align_documents(spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in lone] == [(None, 0, 0, 0, 0, 0, 0, "")] * 2


def test_alignment_query(spark, sf, tokenizers_):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want, _ = plain_alignment([r.text for r in docs], tokenizers_)
    got = {r.doc_id: r for r in QUERIES["op12_token_alignment"](spark, sf).collect()}
    for r, w in zip(docs, want):
        assert tuple(got[r.doc_id])[1:7] == w[:6] and got[r.doc_id].groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=st.sampled_from(list("ab '\n\t.1\u00a0\u2003\u200b\u00e9\u4e2d<>|\u0301\U0001f600")), max_size=40))
def test_ranks_give_the_tokens_of_the_file(text):
    aligner = token_alignment._aligner((None, None))
    plain = [t.encode("utf-8", "ignore").decode() for t in ("<|endoftext|>" + text, text)]
    assert [x.tolist() for x in aligner.encode_a(plain)] == [x.tolist() for x in WHOLE.setdefault("file", aligner._whole())(plain)]


def test_large_groups_are_counted(tokenizers_):
    """Groups whose ids are counted first give the links of those that are paired one by one."""
    texts = ["\u4e2d\u6587" * 40 + "\U0001f600" * 50, "zz " * 30]
    aligner = token_alignment._aligner((None, None))
    one = token_alignment.Slice.of(texts, aligner)
    large, token_alignment.LARGE = token_alignment.LARGE, 1
    try:
        two = token_alignment.Slice.of(texts, aligner)
    finally:
        token_alignment.LARGE = large
    sums = [Counter() for _ in range(2)]
    for s, c in zip((one, two), sums):
        for doc, pair, n in zip(s.text.tolist(), s.pairs[s.which].tolist(), s.links.tolist()):
            c[doc, pair] += n
    assert sums[0] == sums[1]


# --- periodic runs

def plain_runs(words, least=24, power=3):
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, power * q) and not any(all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_texts():
    rng = random.Random(8)
    out = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
            parts += unit * rng.randrange(1, 12) + [rng.choice("abcd") for _ in range(rng.randrange(6))]
        out.append(" ".join(parts))
    fib = ["a", "b"]
    for _ in range(12):
        fib.append(fib[-1] + fib[-2])
    return out + [" ".join(fib[-1]), "x " * 600, "the end \n" * 9, " ".join(bin(i).count("1") % 2 * "b" or "a" for i in range(256))]


def test_runs_equal_plain_version(spark):
    texts = run_texts() + [None, "", " \t ", "one", "a b " * 11 + "a", "a b " * 12, "a b c " * 8, "\x00 x\x00 x\x00y " * 9]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, runs int").repartition(3)
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(df).collect()}
    for i, t in enumerate(texts):
        words = (t or "").split()
        want = plain_runs(words)
        assert [tuple(r) for r in got[i].runs] == want, t[:60]
        drop = {k for s, n, q in want for k in range(s + q, s + n)}
        assert got[i].collapsed == " ".join(w for k, w in enumerate(words) if k not in drop)
        top = max(want, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        assert (tuple(got[i].top) if got[i].top else None) == top
    assert sum(len(got[i].runs) > 1 for i in got) > 10
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=70), st.integers(2, 4), st.integers(4, 12))
def test_runs_of_short_sequences(words, power, least):
    code = np.array([ord(w) for w in words], dtype=np.int64)
    assert periodic_runs.runs_of([[w.encode() for w in words]], least, power)[0] == plain_runs(words, least, power)
    assert periodic_runs.find_runs(code, least, power) == plain_runs(words, least, power)


def test_long_run_takes_little_time(spark):
    words = [b"x"] * 200_000
    assert periodic_runs.runs_of([words]) == [[(0, 200_000, 1)]]
    unit = [b"%d" % i for i in range(50)]
    assert periodic_runs.runs_of([unit * 4000]) == [[(0, 200_000, 50)]]


def test_periodic_runs_query(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    planted = 0
    for r in docs:
        words, h = (r.text or "").split(), zlib.crc32(str(r.doc_id).encode())
        if any(c in (r.text or "") for c in "\x1c\x1d\x1e\x1f\x85\xa0\u2003"):
            continue
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 1500:
            continue
        want = plain_runs(words)
        planted += bool(want)
        mine = got[r.doc_id]
        assert mine.n_runs == len(want)
        assert mine.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in want).encode()).hexdigest()
        drop = {k for s, m, q in want for k in range(s + q, s + m)}
        assert mine.collapsed_sha256 == hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in drop).encode()).hexdigest()
        top = max(want, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert (mine.start, mine.length, mine.period, mine.exponent_milli) == ((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
    assert planted > 5 and len(got) == len(docs)
