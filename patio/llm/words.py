"""Distinct words of a batch of texts, found on bytes with numpy.

Vocabulary work is done once for each distinct word of a batch instead of once for each word.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(3)
#: A random odd number for each byte value; the hash of a word is the sum of these times powers.
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


_INVERSE = pow(int(_FACTOR), -1, 1 << 64)
_kept: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2^64, kept between batches."""
    if base not in _kept or len(_kept[base]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _kept[base] = np.multiply.accumulate(out)
    return _kept[base][:n]


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run without ASCII white space, and the first word of each row."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    word = ~space
    before = np.concatenate(([False], word[:-1])) & ~edge[:-1] if len(data) else np.zeros(0, bool)
    after = np.concatenate((word[1:], [False])) & ~edge[1:] if len(data) else np.zeros(0, bool)
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return start, end, np.searchsorted(start, at)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges start .. start + size, end to end."""
    total = int(size.sum())
    return np.arange(total) + np.repeat(start - (np.cumsum(size) - size), size)


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of its distinct word, and a word that stands for each number.

    Words meet by a 64-bit hash; their bytes are compared with those of the word that stands
    for them, and words that differ from it get numbers of their own.
    """
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(int(_FACTOR), len(data)), dtype=np.uint64)))
    size = end - start
    code = (sums[end] - sums[start]) * _powers(_INVERSE, len(data) + 1)[start] + size.astype(np.uint64) * _FACTOR
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    stand = first[number]
    same = size == size[stand]
    check = np.flatnonzero(same & (stand != np.arange(len(start))))
    differ = data[spans(start[check], size[check])] != data[spans(start[stand[check]], size[check])]
    if differ.any():
        same[np.repeat(check, size[check])[differ]] = False
    odd = np.flatnonzero(~same)
    if len(odd):
        raw = data.tobytes()
        seen: dict[bytes, int] = {}
        extra = []
        for k in odd.tolist():
            word = raw[start[k] : end[k]]
            if word not in seen:
                seen[word] = len(first) + len(extra)
                extra.append(k)
            number[k] = seen[word]
        first = np.concatenate((first, extra))
    return number, first
