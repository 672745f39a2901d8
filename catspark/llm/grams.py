"""Word symbols and rolling hashes over batches of texts, with numpy."""

from __future__ import annotations

import numpy as np

#: fixed odd multipliers: of the rolling polynomial, and of the final mix
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def symbols(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of polynomial hashes over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(32))


def rolling(s: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of each run of ``k`` symbols; entry i starts at symbol i.

    Runs are doubled and joined, so this takes about 2 log2(k) passes.
    """
    power = lambda n: np.uint64(pow(BASE, n, 1 << 64))
    done, width = None, 0
    block, size = s, 1
    while True:
        if k & size:
            if done is None:
                done, width = block, size
            else:  # block covers symbols i .. i + size - 1, what is done follows
                n = len(block) - width
                done, width = block[:max(n, 0)] * power(width) + done[size:], width + size
                done = done[:max(len(s) - width + 1, 0)]
        size *= 2
        if size > k:
            return done[:max(len(s) - k + 1, 0)]
        half = size // 2
        block = block[:-half] * power(half) + block[half:] if len(block) > half else block[:0]


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` entries."""
    size = 1
    while 2 * size <= w:
        a, size = np.minimum(a[:-size], a[size:]) if len(a) > size else a[:0], 2 * size
    rest = w - size
    return np.minimum(a[:-rest], a[rest:]) if rest and len(a) > rest else a[:0] if rest else a


def starts_within(counts: np.ndarray, k: int) -> np.ndarray:
    """Positions in the joined texts at which a run of ``k`` words stays within its text."""
    room = np.maximum(counts - k + 1, 0)
    first = np.cumsum(counts) - counts
    return np.repeat(first - (np.cumsum(room) - room), room) + np.arange(room.sum())


def first_of_runs(a: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Indexes at which the value or its owner changes."""
    if not len(a):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (owner[1:] != owner[:-1])])
