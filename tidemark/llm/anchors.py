"""Content-chosen places in byte strings: every string of ``length`` bytes names one of its own places.

The place is the leftmost one where the hash of the next GRAM bytes is smallest.  It
depends on nothing but the string, so equal strings name equal places wherever they are."""

from __future__ import annotations

import numpy as np

GRAM = 40
U = np.uint64


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each place on (GRAM = 32 + 8, by doubling)."""
    h = _scramble(raw.astype(U) + U(1))
    eight = h
    for k, width in enumerate((1, 2, 4, 8, 16)):
        h = h[: len(h) - width] * U(0x9E3779B97F4A7C15 + 2 * k) + (h[width:] ^ (h[width:] >> U(29)))
        if width == 4:
            eight = h
    return _scramble(h[: len(h) - 8] * U(0xD6E8FEB86659FD93) + eight[32 : 32 + len(h) - 8])


def _window_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` neighbours."""
    n = len(x) - w + 1
    whole = -(-len(x) // w) * w
    padded = np.concatenate((x, np.full(whole - len(x), np.iinfo(x.dtype).max, dtype=x.dtype))).reshape(-1, w)
    left = np.minimum.accumulate(padded, axis=1).reshape(-1)
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def anchors(raw: np.ndarray, length: int, block: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash) for each named place: strings starting at first..last name it.

    Works through blocks, so memory stays bounded for a long text."""
    out = []
    n = len(raw) - length + 1
    for lo in range(0, max(n, 0), block):
        hi = min(n, lo + block)
        h = gram_hashes(raw[lo : hi + length - 1])
        at = np.arange(len(h), dtype=U)
        best = _window_minimum((h & ~U(0xFFFFFFFF)) | at, length - GRAM + 1)
        place = (best & U(0xFFFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        out.append((place[cut] + lo, cut + lo, np.concatenate((cut[1:], [len(place)])) - 1 + lo, h[place[cut]]))
    if not out:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, np.zeros(0, dtype=U)
    return tuple(np.concatenate(c) for c in zip(*out))
