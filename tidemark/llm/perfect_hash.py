"""Minimal perfect hashing of integer keys by a cascade of bit arrays.

Each level has two bits a key.  A key that has its bit for itself stays on the level; those
that meet there go to the next one.  The number of a key is the rank of its bit.
Keys outside the set get a number too, so the keys are kept by number and compared."""

from __future__ import annotations

import pickle

import numpy as np

from .shingles import mix

U = np.uint64
#: Bits for each key on a level, and levels before the few keys left are put into a list.
BITS_A_KEY, LEVELS = 2, 40


class PerfectHash:
    """Numbers 0 to n - 1 for ``n`` distinct keys (64 bits, unsigned)."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        rest = keys = np.asarray(keys, dtype=U)
        while len(rest) and len(self.levels) < LEVELS:
            size = -(-BITS_A_KEY * len(rest) // 64) * 64
            at = self._place(rest, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(U))
            rest = rest[~alone[at]]
        self.rest = np.sort(rest)
        self._ranks()
        self.keys = np.zeros(len(keys), dtype=U)
        self.keys[self._numbers(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + U((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % U(size)).astype(np.int64)

    def _ranks(self) -> None:
        """How many bits are set before each word, over all levels."""
        self.before, done = [], 0
        for words in self.levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(done + np.cumsum(ones) - ones)
            done += int(ones.sum())
        self.listed = done

    def _numbers(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            if not len(open_):
                return out
            at = self._place(keys[open_], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(U)
            hit = (word >> bit) & U(1) == 1
            rank = before[at >> 6] + np.bitwise_count(word & ((U(1) << bit) - U(1)))
            out[open_[hit]] = rank[hit]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            same = self.rest[at] == keys[open_]
            out[open_[same]] = self.listed + at[same]
        return out

    def to_bytes(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        out = cls.__new__(cls)
        vars(out).update(pickle.loads(data))
        return out

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that aren't in the set."""
        keys = np.asarray(keys, dtype=U)
        at = self._numbers(keys)
        known = np.flatnonzero(at >= 0)
        at[known[self.keys[at[known]] != keys[known]]] = -1
        return at
