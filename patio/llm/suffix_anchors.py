"""Anchors of a text: places that only their surroundings choose.

Every stretch of LONG bytes looks at its first WINDOW places and takes the one with the smallest
hash of GRAM bytes as its anchor. Equal stretches take the same place, so repeats meet at
anchors. Neighbouring stretches mostly share an anchor, which leaves about one anchor in half a
window. An anchor cuts the text into phrases, the letters of the suffix array.
"""

from __future__ import annotations

import numpy as np

LONG = 400
WINDOW = 300
GRAM = 12
#: Bytes right of an anchor that each of its stretches holds.
RIGHT = LONG - WINDOW + 1

_RANDOM = np.random.default_rng(41)
_BYTE = _RANDOM.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_WORD = _RANDOM.integers(1, 1 << 63, 2, dtype=np.uint64)
_FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict[int, np.ndarray] = {}


def _power(factor: int, n: int) -> np.ndarray:
    if factor not in _powers or len(_powers[factor]) < n:
        out = np.full(max(n, 1 << 16), factor, np.uint64)
        out[0] = 1
        _powers[factor] = np.multiply.accumulate(out)
    return _powers[factor][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Hasher:
    """Hashes of any stretches of a batch of bytes or of 64-bit numbers, from sums over all of it."""

    def __init__(self, data: np.ndarray, kind: int):
        factor = _FACTORS[kind]
        value = _BYTE[kind][data] if data.dtype == np.uint8 else mixed(data + _WORD[kind])
        self.back = _power(pow(factor, -1, 1 << 64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value * _power(factor, len(data)), out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed(self.raw(start, end) + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def anchors(data: np.ndarray, at: np.ndarray, long: int = LONG, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Columns of the anchors of all rows: row, number in the row, place, first and last start of
    its stretches (all places count from the row's first byte), a (its letter, positive), cover
    (bytes of its phrase), kr (its key) and f (hash of all bytes of its stretches, and where the
    anchor is among them). Other stretches and windows may be given, and 64-bit numbers as bytes."""
    right = long - window + 1
    names = ("row", "i", "p", "cover", "lo", "hi", "a", "kr", "f")
    size = np.diff(at)
    rows = np.flatnonzero(size >= long)
    if not len(rows):
        return {n: np.zeros(0, np.int64) for n in names}
    first, second = Hasher(data, 0), Hasher(data, 1)
    every = np.arange(len(data) - gram + 1)
    picked = mixed(first.raw(every, every + gram)) >> np.uint64(32)
    least = (picked << np.uint64(32)) | every.astype(np.uint64)
    wide = 1
    while wide < window:  # minima over windows of wide places, doubled
        step = min(wide, window - wide)
        least = np.minimum(least[:-step], least[step:])
        wide += step
    count = size[rows] - long + 1
    start = np.arange(count.sum()) + np.repeat(at[rows] - (np.cumsum(count) - count), count)
    owner = np.repeat(rows, count)
    place = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]))))
    row, p, lo = owner[new], place[new], start[new]
    hi = start[np.append(new[1:], len(start)) - 1]
    head = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    number = np.arange(len(row)) - np.repeat(head, np.diff(np.append(head, len(row))))
    inside = mixed((p - lo).astype(np.uint64) * np.uint64(1 << 20) + (hi - lo).astype(np.uint64))
    base = at[row]
    last = np.append(row[1:] != row[:-1], True)
    stop = np.where(last, p + right, np.append(p[1:], 0) + gram)
    return {
        "row": row, "i": number, "p": p - base, "cover": stop - p, "lo": lo - base, "hi": hi - base,
        "a": (first(p, stop) >> np.uint64(2)).astype(np.int64) + 1, "kr": first(p, p + right).view(np.int64),
        "f": (second(lo, hi + long) ^ inside).view(np.int64),
    }
