"""Words and shingles of UTF-8 bytes as 64-bit hashes, for whole batches at a time."""

from __future__ import annotations

import numpy as np

MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Byte values as 64-bit numbers, and A-Z as a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Words that end at white space, and words of digits, letters and bytes beyond ASCII.
NOT_SPACE = ~np.isin(np.arange(256), [32, *range(9, 14)])
LETTERS_DIGITS = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of a 64-bit hash: every input bit changes half of the output bits."""
    x = (x ^ (x >> np.uint64(33))) * MIX_1
    x = (x ^ (x >> np.uint64(33))) * MIX_2
    return x ^ (x >> np.uint64(33))


def words(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every word, and the index of the first word of every text (with the end at last)."""
    inside = kept[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] |= inside[edges]
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """A hash for each word, equal for words that differ only in the case of A-Z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), STEP, np.uint64))
    value = mix(FOLD.astype(np.uint64) + np.uint64(1))
    value[~kept] = 0
    return mix(np.add.reduceat(value[data[starts[0] :]] * powers[place], starts - starts[0]))


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words, and the index of the first of every text.

    A text with fewer words, but not none, is one shingle of all its words.
    """
    counts = np.diff(first)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(each)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - first[:-1], each)
    length = np.repeat(np.minimum(counts, size), each)
    out = length.astype(np.uint64) * STEP
    weights = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.append(hashes, np.zeros(size, np.uint64))
    for i in range(size):
        out += np.where(i < length, padded[at + i] * weights[i], np.uint64(0))
    return mix(out), bounds
