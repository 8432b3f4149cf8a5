"""Word shingles of texts as sets of 64-bit numbers, and min-max signatures of such sets."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MEMO_WORDS = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hash = _WordHashes().__getitem__


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: each bit of the input sways all bits of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space."""
    return text.translate(_UPPER_TO_LOWER).split()


def sequence_hash(words: list[bytes]) -> tuple[int, int]:
    """128-bit hash of the whole sequence, as two signed numbers."""
    h = xxhash.xxh3_128_intdigest(b" ".join(words))
    return tuple(x - (x >> 63 << 64) for x in (h >> 64, h & (1 << 64) - 1))


def shingle_set(words: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingles; of fewer words the whole sequence is one; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hash, words), np.uint64, len(words))
    width = min(size, len(words))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return np.unique(mix(out))


class MinMax:
    """Min-max signatures: each hash function gives a minimum and a maximum, two nearly
    independent samples of the set for one evaluation. Values at the same place agree with
    the probability of the sets' Jaccard similarity."""

    def __init__(self, functions: int = 63, rows: int = 5, seed: int = 20240607):
        r = np.random.default_rng(seed)
        self.factors = r.integers(1, 1 << 63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.masks = r.integers(0, 1 << 63, functions, dtype=np.uint64)
        self.rows, self.bands = rows, 2 * functions // rows

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """2 x functions values: minima and maxima."""
        low = np.empty((2, len(self.factors)), np.uint64)
        for i, (a, m) in enumerate(zip(self.factors, self.masks)):
            x = (shingles ^ m) * a
            x ^= x >> np.uint64(32)
            x *= a
            low[0, i], low[1, i] = x.min(), x.max()
        return low

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        """One signed 64-bit key per band of `rows` values; the band's number is part of it."""
        values = self.signature(shingles).T.reshape(-1)[: self.bands * self.rows].reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for i in range(self.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
        return key.view(np.int64)


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
