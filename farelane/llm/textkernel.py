"""Numpy kernels over Arrow text batches: words, word hashes, window hashes.

A word is a run of bytes other than 0x20 and 0x09-0x0D, so words can be found
on UTF-8 bytes.  A word's 64-bit hash mixes its length and its bytes, eight at a time; that of a
very long word combines two polynomial prefix hashes with different bases.  A window's hash is a polynomial
of its words' hashes.
Everything is vectorised over a batch; byte-level work is done in bounded
chunks, so one very long text costs memory in proportion to its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
CHUNK = 1 << 17

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

# Odd multipliers; their inverses modulo 2**64 undo a window's offset.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
_POWERS: dict = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + 64)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = tuple(out)
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of every row (rows + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = SPACE[data]
    edge = np.empty(len(data), bool)
    edge[0], edge[1:] = True, space[:-1]
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge & ~space)
    edge[-1], edge[:-1] = True, space[1:]
    edge[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(edge & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: eight bytes at a time, words over ``LONG_WORD`` bytes by prefix sums."""
    size = ends - starts
    out = np.empty(len(starts), U)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK, "right")))
        base, n = starts[lo], int(ends[hi - 1] - starts[lo])
        body = np.zeros(n // 8 + 2, "<u8")
        body.view(np.uint8)[:n] = data[base:base + n]
        at, left = starts[lo:hi] - base, np.minimum(size[lo:hi], LONG_WORD)
        part = _EIGHT[3][left]
        rows = slice(None)
        while len(left):
            x = _eight_bytes(body, at) & _EIGHT[2][np.minimum(left, 8)]
            part[rows] = mix(part[rows] ^ x)
            on = np.flatnonzero(left > 8)
            rows = on if isinstance(rows, slice) else rows[on]
            at, left = at[on] + 8, left[on] - 8
        out[lo:hi] = part
        lo = hi
    large = np.flatnonzero(size > LONG_WORD)
    if len(large):
        out[large] = _long_hashes(data, starts[large], ends[large])
    return out


LONG_WORD = 64
# Shifts to the right and left that join the halves of eight unaligned bytes, masks by length, first values by length.
_EIGHT = (np.arange(8, dtype=U) * U(8), U(63) - np.arange(8, dtype=U) * U(8),
          np.array([(1 << 8 * k) - 1 for k in range(9)], U), mix(np.arange(LONG_WORD + 1, dtype=U) * U(BASES[0]) + U(BASES[1])))


def _eight_bytes(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as little-endian numbers."""
    word, inside = at >> 3, at & 7
    return (body[word] >> _EIGHT[0][inside]) | ((body[word + 1] << U(1)) << _EIGHT[1][inside])


def _long_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), U)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK, "right")))
        base = starts[lo]
        chunk = data[base:ends[hi - 1]].astype(U) + U(1)
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        parts = []
        for b in BASES[:2]:
            up, down = _powers(b, len(chunk))
            sums = np.zeros(len(chunk) + 1, U)
            np.cumsum(chunk * up, out=sums[1:])
            parts.append((sums[e] - sums[s]) * down[s])
        out[lo:hi] = mix(mix(parts[0]) + parts[1] * U(BASES[2]))
        lo = hi
    return out


def window_hashes(words: np.ndarray, k: int, base: int = BASES[2]) -> np.ndarray:
    """Hash of the k words from each word on (k or more words; windows may cross rows)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.empty(n, U)
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        part = words[lo:hi + k - 1]
        up, down = _powers(base, len(part) + 1)
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(part * up[:-1], out=sums[1:])
        out[lo:hi] = mix((sums[k:] - sums[:-k]) * down[:hi - lo])
    return out


def windows_inside(first_word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of every window that lies within one row, and how many each row has."""
    counts = np.maximum(np.diff(first_word) - (k - 1), 0)
    return ranges(first_word[:-1], counts), counts


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``starts[i] .. starts[i] + counts[i] - 1``."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)
