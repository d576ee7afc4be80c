"""Vectorised 64-bit hashes of byte ranges (words) and of sequences of words (shingles).

A range is read in blocks of eight bytes, each of which changes the state one to one before it is mixed: there is no
polynomial whose structure texts could hit upon. Ranges beyond LONG bytes go through BLAKE2b.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes of a range from which it is hashed by itself.
LONG = 128
#: An odd multiplier and the constants of the finalizer.
_BASE = 0x9E3779B97F4A7C15
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of raw[start:end] for each range; equal bytes have equal hashes."""
    left = ends - starts
    out = left.astype(np.uint64) * np.uint64(_BASE)
    if not len(out):
        return out
    blocks = np.lib.stride_tricks.sliding_window_view(np.append(raw, np.zeros(8, np.uint8)), 8)
    some = np.flatnonzero((left > 0) & (left <= LONG))
    at, left_of = starts[some], left[some]
    while len(some):
        block = blocks[at].view("<u8").ravel()
        part = left_of < 8
        block[part] &= (np.uint64(1) << (left_of[part] * 8).astype(np.uint64)) - np.uint64(1)
        out[some] = mix((out[some] ^ block) * np.uint64(_BASE))
        more = left_of > 8
        some, at, left_of = some[more], at[more] + 8, left_of[more] - 8
    for i in np.flatnonzero(left > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def shingle_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a row, and the n+1 positions of the rows among them.

    A row with fewer words, but at least one, has its whole sequence as one shingle.
    """
    counts = np.diff(rows)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    at = np.append(0, np.cumsum(n))
    first = np.repeat(rows[:-1] - at[:-1], n) + np.arange(at[-1])
    length = np.repeat(np.minimum(counts, size), n)
    out = length.astype(np.uint64) * np.uint64(_BASE)
    for k in range(size):
        inside = k < length
        word = words[np.minimum(first + k, max(len(words) - 1, 0))] if len(words) else np.zeros(len(first), np.uint64)
        out = np.where(inside, mix(out * np.uint64(_BASE) + word), out)
    return out, at
