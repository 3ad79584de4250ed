"""Words and word shingles of whole texts as 64-bit hashes, in numpy over the bytes of an Arrow batch.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return;
A-Z count as a-z. Texts are UTF-8, in which no other character holds these bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def powers(base: int, size: int) -> np.ndarray:
    return _powers(base, 1 << max(12, (size - 1).bit_length()))[:size]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of the first word in it or after it."""
    solid = ~BLANK[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = solid[cuts]
    ends[cuts - 1] = solid[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and the first word of each row: sums of byte times power, taken as differences of one running sum."""
    starts, ends, first = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, first
    run = np.zeros(len(data) + 1, np.uint64)  # all in this one array, as it takes eight bytes for each of a text's
    sums = run[1:]
    sums[:] = LOWER[data]
    sums += np.uint64(1)
    sums *= powers(BASE, len(data))
    np.cumsum(sums, out=sums)
    return mix((run[ends] - run[starts]) * powers(INVERSE, len(data))[starts]), starts, ends, first


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n words in a row, across row ends too: the caller drops those."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for j in range(1, n):
        out = out * STEP + words[j : len(words) - n + 1 + j]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int):
    """For each row its sorted distinct shingle hashes; fewer than n words count as one shingle, none as none."""
    words, _, _, first = word_hashes(data, offsets)
    hashes = shingle_hashes(words, n)
    for i in range(len(offsets) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= n:
            one = np.sort(hashes[a : b - n + 1])
            keep = np.ones(len(one), bool)
            np.not_equal(one[1:], one[:-1], out=keep[1:])
            yield one[keep]
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for w in words[a:b]:
                whole = whole * STEP + w
            yield mix(whole)
        else:
            yield np.zeros(0, np.uint64)
