"""Word shingles of whole texts as 64-bit hashes, with numpy over many texts at once."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Bytes hashed at a time, so that a long text takes bounded memory besides its own size.
BLOCK = 1 << 18

U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _factors(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


_POSITIONS = _factors(64, 1)
_STEPS = _factors(SHINGLE, 2)


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each run of non-space bytes."""
    global _POSITIONS
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=U)
    lengths = ends - starts
    if lengths.max() > len(_POSITIONS):
        _POSITIONS = _factors(int(lengths.max()), 1)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    sums = np.add.reduceat((raw[word].astype(U) + U(1)) * _POSITIONS[place], first)
    return starts, mix(sums + lengths.astype(U) * U(0x9E3779B97F4A7C15))


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text, A-Z lower-cased.

    Words are runs of characters other than ASCII white space.  A text of fewer
    words has its whole sequence as the one shingle; without words it has none."""
    raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(raws):  # texts in groups of about BLOCK bytes
        upto, size = at, 0
        while upto < len(raws) and (upto == at or size + len(raws[upto]) <= BLOCK):
            size += len(raws[upto]) + 1
            upto += 1
        out += _group_sets(raws[at:upto], n)
        at = upto
    return out


def _group_sets(raws: list[bytes], n: int) -> list[np.ndarray]:
    joined = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
    bounds = np.cumsum([0] + [len(r) + 1 for r in raws])
    starts, hashes = [], []
    at = 0
    while at < len(joined):  # cut behind a space
        upto = min(at + BLOCK, len(joined))
        while upto < len(joined) and not _SPACE[joined[upto - 1]]:
            more = np.flatnonzero(_SPACE[joined[upto : upto + BLOCK]])
            upto = upto + int(more[0]) + 1 if len(more) else min(upto + BLOCK, len(joined))
        s, h = _word_hashes(joined[at:upto])
        starts.append(s + at)
        hashes.append(h)
        at = upto
    start, word = np.concatenate(starts), np.concatenate(hashes)
    first = np.searchsorted(start, bounds)
    steps = _STEPS if n <= SHINGLE else _factors(n, 2)
    full = np.zeros(0, dtype=U)
    if len(word) >= n:
        full = np.zeros(len(word) - n + 1, dtype=U)
        for k in range(n):
            full += word[k : len(word) - n + 1 + k] * steps[k]
        full = mix(full + U(n))
    out = []
    for lo, hi in zip(first[:-1], first[1:]):
        if hi - lo >= n:
            out.append(np.unique(full[lo : hi - n + 1]))
        elif hi > lo:
            short = (word[lo:hi] * steps[: hi - lo]).sum(dtype=U) + U(hi - lo)
            out.append(mix(np.array([short], dtype=U)))
        else:
            out.append(np.zeros(0, dtype=U))
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
