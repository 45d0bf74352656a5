"""Operators on pairs against brute force: vectors, shingle sets, repeated bytes; components."""

import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import common, embedding_dedup, jaccard_join, suffix_dedup
from tidemark.llm.components import components
from tidemark.llm.shingles import overlap, shingle_sets

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "sa", "ti", "vo") for b in ("da", "fe", "gi", "ho", "ju", "pe")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def edited(rng, text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split(" "))


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, n) for n in range(200, 260)]
    rest = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    links = chain + star + rest + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links + [(None, 3)], "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == roots({n for link in real for n in link}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def cosine_links(vectors):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    near = [[ok[i] and ok[j] and i != j and len(vectors[i]) == len(vectors[j]) and embedding_dedup.cosines(
        np.array([vectors[i]], float), np.array([vectors[j]], float))[0] >= 0.9 for j in range(len(vectors))] for i in range(len(vectors))]
    return near


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    near = np.vstack([base[k % 8] + 0.12 * rng.standard_normal(16) for k in range(60)])
    vectors = [list(map(float, v)) for v in np.vstack([base, near, base[:5] * 3.0, base[:5]])]
    vectors += [[1e300 * x for x in vectors[3]], [1e-300 * x for x in vectors[3]]]
    vectors += [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows = [(100 + i, v, 9) for i, v in enumerate(vectors)] + [(None, vectors[0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    near = cosine_links(vectors + [vectors[0]])
    ids = [r[0] if r[0] is not None else 10**6 for r in rows]
    want = roots(ids, [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if near[i][j]])
    assert len(got) == len(rows)
    for i, row in enumerate(rows[:-1]):
        r = got[row[0]]
        assert (r.n_links, r.component_id, r.kept) == (sum(near[i]), want[row[0]], want[row[0]] == row[0])
    assert (got[None].n_links, got[None].kept) == (sum(near[-1]), False)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_large_crowd_is_counted_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 50)
    rng = np.random.default_rng(4)
    v = np.ones(12) + 0.02 * rng.standard_normal((230, 12))
    df = spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicates(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(229, 0)}


def test_boundaries_between_ranges_are_compared(spark):
    rng = np.random.default_rng(5)
    same = np.packbits(rng.integers(0, 2, 256)).tobytes()
    df = spark.createDataFrame([(0, 16, 0, i, 0.85, same) for i in range(60)], "pass int, dim int, key long, entry long, same float, sketch binary")
    pairs = {(r.a, r.b) for r in embedding_dedup._candidates(df, 4, 0).collect()}
    assert pairs == {(i, j) for i in range(60) for j in range(i + 1, min(60, i + 5))}


def test_pairs_within_a_dense_group_are_found(spark):
    rng = np.random.default_rng(6)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    def beside(v, cosines, n):
        r = rng.standard_normal((n, v.shape[-1]))
        r -= (r * v).sum(axis=1, keepdims=True) * v
        return cosines * v + math.sqrt(1 - cosines**2) * unit(r)

    dense = beside(unit(rng.standard_normal((1, 64))), math.sqrt(0.7), 2000)  # mean cosine 0.7 within a third of the rows
    vectors = np.vstack([dense, unit(rng.standard_normal((4000, 64))), beside(dense[:300], 0.92, 300)])
    df = spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    near = vectors @ vectors.T >= 0.9
    np.fill_diagonal(near, False)
    want = roots(range(len(vectors)), zip(*map(lambda x: x.tolist(), np.nonzero(near))))
    group = [*range(2000), *range(6000, 6300)]
    wrong = [i for i in group if (got[i].n_links, got[i].component_id) != (near[i].sum(), want[i])]
    assert not wrong


def test_links_at_the_threshold_are_told_alike(spark):
    """A pair exactly at the threshold is a link in every way of counting, whatever block it meets in."""
    x = np.array([[1.0, 0.0, 0.0]] * 3 + [[0.9, math.sqrt(1 - 0.81), 0.0]] * 2)
    alone = embedding_dedup.cosines(x[:1], x[3:4])[0] >= 0.9
    assert (embedding_dedup.linked(x[:3], x[3:], 0.9) == alone).all()


def word_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def corpus():
    rng = random.Random(2)
    base = [prose(rng, rng.choice([3, 8, 40, 120])) for _ in range(30)]
    texts = base + [edited(rng, t, rng.choice([0.01, 0.03, 0.05, 0.1])) for t in base * 4] + base[:6] + [t.upper() for t in base[:3]]
    shared = prose(rng, 30)
    texts += [shared + " " + prose(rng, n) for n in range(1, 25)]
    return texts + [None, "", " \n\t", "one", "ONE", "Ä b c", "ä b c", "a b c d e f"]


def test_shingle_sets():
    texts = corpus() + ["x" * 5000 + " y"] + [" ".join(["w"] * 9)]
    sets = shingle_sets(texts)
    assert [len(s) for s in sets] == [len(word_set(t)) for t in texts]
    a, b = sets[0], sets[30]
    assert overlap(a, b) == len(word_set(texts[0]) & word_set(texts[30]))
    hashed = {}
    for t, s in zip(texts, sets):
        for one in [s.tobytes()] if len(s) == 1 else []:
            assert hashed.setdefault(one, word_set(t)) == word_set(t)


def jaccard_roots(ids, texts):
    sets = [word_set(t) for t in texts]
    links = []
    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                links.append((ids[i], ids[j]))
    return sets, roots(ids, links)


@pytest.mark.parametrize("part", [20_000, 60])
def test_jaccard_join_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(jaccard_join, "PART", part)
    monkeypatch.setattr(jaccard_join, "MEETING", 7)
    texts = corpus()
    ids = list(range(500, 500 + len(texts)))
    df = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)], "doc_id int, text string, n_shingles int").repartition(5)
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(df, cells=10).collect()}
    sets, want = jaccard_roots(ids, texts)
    for i, s in zip(ids, sets):
        assert (got[i].n_shingles, got[i].component_id) == (len(s), want[i])


def test_jaccard_join_without_broadcast(spark, monkeypatch):
    """Meetings too many to broadcast: texts that take part in none stay out of the shuffle, with the same groups."""
    asked = []
    monkeypatch.setattr(jaccard_join, "sized", lambda df: df)
    monkeypatch.setattr(jaccard_join, "among", lambda df, n, bits: asked.append(1) or common.among(df, n, bits))
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    _, want = jaccard_roots(list(range(len(texts))), texts)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df, cells=10).collect()}
    assert [got[i] for i in range(len(texts))] == [want[i] for i in range(len(texts))] and asked


def test_bytes_of_shared_tokens_come_back():
    for kind in ("<u2", "<u4", np.uint64, np.int64):
        x = np.array([0, 1, 255, 256, 65535], dtype=kind)
        assert (jaccard_join._from_planes(jaccard_join._planes(x), kind) == x).all()


def test_jaccard_join_odd_rows(spark):
    rng = random.Random(6)
    a, b, c = prose(rng, 40), prose(rng, 40), prose(rng, 40)
    big = 2**60 + 1
    rows = [(9, a), (9, a), (big, "some " + b + " other " + b), (4, b), (4, a), (None, b), (None, c), (7, c + " more"), (None, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.near_duplicates(df).collect()), key=str)
    assert got == sorted([(9, 36, 4), (9, 36, 4), (4, 36, 4), (4, 36, 4), (None, 36, 4), (None, 36, 7), (7, 37, 7), (None, 0, None), (3, 0, 3), (big, 42, 4)], key=str)
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for r in raws:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((len(r), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), np.frombuffer(r, np.uint8)[~gone].tobytes()))
    return out


def test_suffix_repeats_against_brute_force(spark):
    rng = random.Random(7)
    passage, line = prose(rng, 60), prose(rng, 20)
    texts = [prose(rng, 30) + " " + passage[rng.randrange(60) : rng.randrange(250, 500)] + " " + prose(rng, 40) for _ in range(25)]
    texts += [prose(rng, 5) + line + "é" + prose(rng, 9) + line for _ in range(5)]
    texts += [texts[0], texts[0], texts[1][:-3], passage[:200], passage[:199], "ab" * 300, "x" * 450, "short", "short", "", None]
    texts += [prose(rng, 200)] * 2 + [passage + " " + passage]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    for i, want in enumerate(repeats(texts, 200)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want, i
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_crowded_leading_bytes_are_split(spark):
    rng = random.Random(9)
    passage = prose(rng, 40).encode()
    found = []
    for k in range(400):  # all cut around one place of a passage, with bytes of their own or of a few others at its ends
        before, after = rng.choice([b"", prose(rng, 1).encode(), b"same "]), prose(rng, 2).encode()
        found.append((k, -k, 2 if k == 7 else 1, passage[100:140], before + passage[80 : 280 + rng.randrange(30)] + after))
    found += [(1000 + k, 0, 1, prose(rng, 9).encode()[:40], prose(rng, 40).encode()) for k in range(20)]
    rows = [(c1, c2, lead, b) for c1, c2, times, lead, b in found for _ in range(times)]
    contexts = spark.createDataFrame([(a, b, bytearray(x), bytearray(y)) for a, b, x, y in rows], "c1 long, c2 long, lead binary, bytes binary")
    masks = suffix_dedup.repeated_windows([f[4] for f in found], 200)
    want = {(f[0], s, e) for f, m in zip(found, masks) for s, e in ([(0, len(f[4]))] if f[2] > 1 else suffix_dedup._runs(m, 200))}
    for piece in (5_000, 1 << 20):  # split, and together
        got = [(r.c1, r.start, r.end) for r in suffix_dedup._bucket_spans(contexts, 200, piece).collect()]
        assert len(got) == len(set(got)) and set(got) == want, piece


def test_suffix_repeats_without_any(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, prose(rng, 40)) for i in range(3)] + [(None, "x" * 10)], "doc_id long, text string")
    assert {r.n_removed for r in suffix_dedup.remove_repeats(df).collect()} == {0}


def test_long_text_in_blocks():
    rng = np.random.default_rng(9)
    raw = rng.integers(97, 123, 5000).astype(np.uint8)
    from tidemark.llm.anchors import anchors

    whole, cut = anchors(raw, 200), anchors(raw, 200, block=700)
    starts = [{s: int(p) for p, f, t, _ in zip(*a) for s in range(f, t + 1)} for a in (whole, cut)]
    assert starts[0] == starts[1] and sorted(starts[0]) == list(range(4801))
