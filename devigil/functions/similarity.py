"""String similarity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    mask = (1 << len(a)) - 1
    row = mask
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def indel_similarity(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 2.0 * common_subsequence(a, b) / total if total else 1.0


@F.pandas_udf(T.DoubleType())
def _indel_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        yield pd.Series(
            [
                None if a is None or b is None else indel_similarity(a, b)
                for a, b in zip(left, right)
            ],
            dtype="float64",
        )


def indel_ratio(a: Column, b: Column) -> Column:
    """``2 * LCS / (len a + len b)`` in [0, 1]; a substitution costs an insertion and a deletion."""
    return _indel_ratio(a, b)


# Cells of the tables of one step; longer names are worked on in fewer rows at a time.
KERNEL_CELLS = 1 << 20


def _codes(names: Sequence[str], pad: int) -> np.ndarray:
    out = np.full((len(names), max(map(len, names), default=0)), pad, dtype="int64")
    for row, name in zip(out, names):
        row[: len(name)] = np.frombuffer(name.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return out


def _shared_weight(left: np.ndarray, right: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Summed weight of the common subsequences of ``order`` characters, for rows of codes.

    Entry i, j of ``ending`` weighs those that end at i and j; ``reached`` sums them up to there with
    every step on decaying. Each order needs the one below, one row and one column up. Rows are taken
    in blocks, and only the last row of a block is kept.
    """
    pairs, width = right.shape
    total = np.zeros(pairs)
    kept = np.zeros((order, pairs, width))
    height = max(1, KERNEL_CELLS // max(1, pairs * width))
    for top in range(0, left.shape[1] if width else 0, height):
        equal = (left[:, top : top + height, None] == right[:, None, :]) * decay**2
        ending = equal
        for row in kept[: order - 1]:
            reached = ending.copy()
            for j in range(1, width):
                reached[:, :, j] += decay * reached[:, :, j - 1]
            reached[:, 0] += decay * row
            for i in range(1, reached.shape[1]):
                reached[:, i] += decay * reached[:, i - 1]
            before = np.zeros_like(reached)
            before[:, 0, 1:] = row[:, :-1]
            before[:, 1:, 1:] = reached[:, :-1, :-1]
            row[:] = reached[:, -1]
            ending = equal * before
        total += ending.sum(axis=(1, 2))
    return total


def _in_batches(pairs: list[tuple[str, str]], order: int, decay: float) -> np.ndarray:
    """Pairs of like lengths together, as many as the cells of a step allow."""
    size = np.array([(max(len(a), len(b)), len(a)) for a, b in pairs]).reshape(-1, 2)
    by_size = np.lexsort(size.T[::-1])
    out, start = np.zeros(len(pairs)), 0
    while start < len(pairs):
        end = start + 1
        while end < len(pairs) and (end + 1 - start) * (size[by_size[end], 0] + 1) ** 2 <= KERNEL_CELLS:
            end += 1
        part = by_size[start:end]
        lefts, rights = zip(*(pairs[i] for i in part))
        out[part] = _shared_weight(_codes(lefts, -1), _codes(rights, -2), order, decay)
        start = end
    return out


def subsequence_similarities(
    left: Sequence[str | None], right: Sequence[str | None], order: int = 2, decay: float = 0.9
) -> list[float | None]:
    """Gap-weighted subsequence kernels, scaled to 1 for equal names.

    A common subsequence counts ``decay`` to the power of the characters it spans in both names. Names
    shorter than ``order`` have none: they are 1 to themselves and 0 to others. NULL gives NULL.
    """
    known = [(a, b) for a, b in zip(left, right) if a is not None and b is not None]
    names = sorted({name for pair in known for name in pair})
    own = dict(zip(names, _in_batches([(n, n) for n in names], order, decay)))
    shared = iter(_in_batches(known, order, decay))
    out: list[float | None] = []
    for a, b in zip(left, right):
        if a is None or b is None:
            out.append(None)
            continue
        weight, scale = next(shared), np.sqrt(own[a]) * np.sqrt(own[b])
        out.append(1.0 if a == b else float(weight / scale) if scale else 0.0)
    return out


def subsequence_similarity(a: Column, b: Column, order: int = 2, decay: float = 0.9) -> Column:
    """``subsequence_similarities`` of two columns, in Arrow batches."""

    @F.pandas_udf(T.DoubleType())
    def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series(
                subsequence_similarities(list(left), list(right), order, decay), dtype="float64"
            )

    return similarity(a, b)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(c, r"\s+"), lambda t: t != "")), " ")
