"""Word shingles as 64-bit numbers."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_number(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


class WordNumbers(dict):
    """64-bit numbers of words, worked out when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = number = word_number(word)
        return number


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * STEP + numbers[k : k + n]
    return mix(h)


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """Make the k-th occurrence of a hash a value of its own, so a multiset is a set."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(ranked)), 0))
    out = np.empty_like(hashes)
    out[order] = ranked + (np.arange(len(ranked)) - start).astype(np.uint64) * STEP
    return out
