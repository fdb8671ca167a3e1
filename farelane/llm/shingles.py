"""Shingle sets and MinHash signatures of text batches (numpy kernels for near-duplicate detection)."""

from __future__ import annotations

import numpy as np

from farelane.llm import textkernel as tk

U = np.uint64
COLUMNS = 1024  # shingles hashed at once: the working set stays in cache, whatever the text's length


def shingle_sets(column, k: int = 5):
    """Per row the sorted distinct 64-bit shingle hashes: lower-cased A-Z, k words each; a shorter text is
    one shingle of all its words; a text without words has none."""
    data, offsets = tk.flat(column)
    data = tk.LOWER[data]
    starts, ends, first = tk.word_bounds(data, offsets)
    words = tk.word_hashes(data, starts, ends)
    windows = tk.window_hashes(words, k)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        n = hi - lo
        if n >= k:
            yield np.unique(windows[lo:hi - k + 1])
        elif n:
            yield tk.mix(tk.window_hashes(words[lo:hi], n) + U(n))
        else:
            yield np.zeros(0, U)


class MinHasher:
    """Universal hash minima: h(x) = (a x + b) mod 2**64 >> 32 with odd a (multiply-shift)."""

    def __init__(self, hashes: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 63, hashes, dtype=np.uint64) << U(1)) | U(1)
        self.b = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) << U(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), ~U(0), U)
        for lo in range(0, len(shingles), COLUMNS):
            h = self.a[:, None] * shingles[None, lo:lo + COLUMNS]
            h += self.b[:, None]
            np.minimum(least, h.min(axis=1), out=least)
        return (least >> U(32)).astype(np.uint32)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` minima."""
    bands = len(signature) // rows
    parts = signature[:bands * rows].astype(U).reshape(bands, rows)
    key = tk.mix(np.arange(bands, dtype=U) + U(0x51ED270B))
    for i in range(rows):
        key = tk.mix(key * U(tk.BASES[1]) + parts[:, i])
    return key


def set_hash(shingles: np.ndarray) -> bytes:
    """128-bit hash of a set (two sums of differently mixed members)."""
    a = tk.mix(shingles * U(tk.BASES[0])).sum(dtype=U)
    b = tk.mix(shingles * U(tk.BASES[3]) + U(len(shingles))).sum(dtype=U)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")
