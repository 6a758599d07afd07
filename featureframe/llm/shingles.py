"""Shingle sets of texts and their MinHash signatures, a batch of documents at a time."""

from __future__ import annotations

import numpy as np
import xxhash

from featureframe.llm.common import word_hashes, words

#: Shingles whose hashes are permuted at once, so that they stay in the processor's cache.
_AT_ONCE = 1 << 15


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles, ASCII letters lower-cased.

    A text of fewer words than ``width`` is one shingle as a whole; one without words has none.
    """
    hashes = word_hashes([word.lower() for word in words(text)]) if text else np.zeros(0, np.uint64)
    n = len(hashes)
    if n == 0:
        return hashes
    if n < width:
        # told apart from shingles of the full width by its length
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=n)], np.uint64)
    total = hashes[: n - width + 1].copy()
    for step in range(1, width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
        total += hashes[step : step + n - width + 1]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


class MinHash:
    """Minima of ``bands * rows`` permutations (and up to a multiple of 64 more for the signature)."""

    def __init__(self, bands: int, rows: int, bits: int, seed: int = 7):
        if 64 % bits:
            raise ValueError("bits must divide 64")
        self.bands, self.rows, self.bits = bands, rows, bits
        per_word = 64 // bits
        self.minima = -(-bands * rows // per_word) * per_word
        random = np.random.default_rng(seed)
        self._xor = random.integers(0, 1 << 32, self.minima, dtype=np.uint32)
        self._factor = random.integers(0, 1 << 31, self.minima, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def __call__(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of minima for each set; none may be empty."""
        out = np.empty((len(sets), self.minima), np.uint32)
        first = 0
        while first < len(sets):
            last, size = first, 0
            while last < len(sets) and (last == first or size + len(sets[last]) <= _AT_ONCE):
                size += len(sets[last])
                last += 1
            values = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
            starts = np.cumsum([0, *(len(one) for one in sets[first : last - 1])])
            mixed = np.empty_like(values)
            for number in range(self.minima):
                np.bitwise_xor(values, self._xor[number], out=mixed)
                np.multiply(mixed, self._factor[number], out=mixed)
                out[first:last, number] = np.minimum.reduceat(mixed, starts)
            first = last
        return out

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band, equal where all its minima are."""
        banded = minima[:, : self.bands * self.rows].astype(np.uint64).reshape(-1, self.bands, self.rows)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), banded.shape[:2]).copy()
        for row in range(self.rows):
            key = (key ^ banded[:, :, row]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        return key.view(np.int64)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        """Low bits of all minima, side by side in 64-bit words.

        The permutations keep which shingles share their low bits, so minima are mixed
        once more: different minima then agree by chance, anew in each permutation.
        """
        mixed = minima.astype(np.uint32)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            mixed ^= mixed >> np.uint32(shift)
            mixed *= np.uint32(factor)
        mixed ^= mixed >> np.uint32(16)
        low = (mixed & np.uint32((1 << self.bits) - 1)).astype(np.uint64)
        per_word = 64 // self.bits
        shifts = np.arange(per_word, dtype=np.uint64) * np.uint64(self.bits)
        return np.bitwise_or.reduce(low.reshape(len(low), self.minima // per_word, per_word) << shifts, axis=2).view(np.int64)
