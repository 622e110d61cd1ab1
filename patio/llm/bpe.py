"""Token ids of byte-level pair merging with word ends, for a batch of texts at a time.

The vocabulary file is one of the public tokenizers: lower case, white space dropped, words cut
into letters, single digits and other signs. Words of Latin letters, digits and signs are cut
and merged here with numpy: all distinct pieces of a batch advance together, and in each round
every piece merges its best-ranked pair, the leftmost of equals. Words with anything else
(other scripts, apostrophes, control characters) and very long ones go to the library, whole.
The ids are those of the library either way.
"""

from __future__ import annotations

import json
import os

import numpy as np

from patio.llm.words import distinct, spans, word_bounds

#: Longer pieces go to the library.
LONGEST = 64
#: Cells of one merging matrix.
CELLS = 1 << 20
#: Distinct library words that a worker remembers between batches.
REMEMBERED = 100_000
NONE = np.int64(1) << 40

_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[ord("'")] = _ODD
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
for _low, _high, _kind in ((ord("0"), ord("9"), _DIGIT), (ord("a"), ord("z"), _LETTER), (ord("A"), ord("Z"), _LETTER)):
    _CLASS[_low : _high + 1] = _kind
_CLASS[0xC3] = _LETTER


def _byte_signs() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    """Vocabulary and ranks of a tokenizer file, with merging in numpy."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        signs = _byte_signs()
        self.inner = np.array([vocab.get(c, -1) for c in signs], np.int64)
        self.last = np.array([vocab.get(c + end, -1) for c in signs], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = (left << 20) | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NONE where the pair does not merge."""
        key = (a << 20) | b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = (self.key[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.rank[at], NONE), self.made[at]

    def merge(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of one size each, end to end, and how many each has."""
        n, width = len(start), int(size.max(initial=1))
        place = np.arange(width)
        inside = place < size[:, None]
        raw = data[np.minimum(start[:, None] + place, len(data) - 1)]
        token = np.where(inside, np.where(place == size[:, None] - 1, self.last[raw], self.inner[raw]), -1)
        count = size.copy()
        rank, made = self.ranks(token[:, :-1], token[:, 1:])
        live = np.arange(n)
        while width > 1 and len(live):
            best = rank[live].argmin(axis=1)
            open_ = rank[live, best] < NONE
            live, best = live[open_], best[open_]
            if not len(live):
                break
            token[live, best] = made[live, best]
            # Everything right of the merged pair moves one place to the left.
            shift = np.minimum(place + (place > best[:, None]), width - 1)
            moved = np.take_along_axis(token[live], shift, axis=1)
            moved[:, -1] = -1
            token[live] = moved
            back = np.minimum(place[:-1] + (place[:-1] > best[:, None]), width - 2)
            rank[live] = np.take_along_axis(rank[live], back, axis=1)
            made[live] = np.take_along_axis(made[live], back, axis=1)
            rank[live, -1] = NONE
            for side in (best - 1, best):
                ok = (side >= 0) & (side < width - 1)
                rows, at = live[ok], side[ok]
                rank[rows, at], made[rows, at] = self.ranks(token[rows, at], token[rows, at + 1])
            count[live] -= 1
        return token[place < count[:, None]], count


class Encoder:
    """Ids of a batch of texts; each distinct piece of a word is merged once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.merges = Merges(path)
        self.tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens in a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, np.ndarray] = {}

    def _library(self, words: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            made = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            self.known.update((w, np.array(e.ids, np.uint32)) for w, e in zip(part, made, strict=True))
        return [self.known[w] for w in words]

    def _pieces(self, data: np.ndarray, at: np.ndarray):
        """Lower-case bytes, start, end and oddness of each piece, and the first piece of each row."""
        kind = _CLASS[data]
        after = np.concatenate(([False], data[:-1] == 0xC3)) if len(data) else np.zeros(0, bool)
        kind[after & (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)] = _LETTER
        start, end, _ = word_bounds(data, at)
        odd = np.concatenate(([0], np.cumsum(kind == _ODD)))
        strange = (odd[end] - odd[start] > 0) | (end - start > LONGEST)
        flip = np.zeros(len(data) + 1, np.int8)
        flip[start[strange]] += 1
        flip[end[strange]] -= 1
        ordinary = np.cumsum(flip[:-1], dtype=np.int8) == 0
        low = data.copy()
        low[(data >= 0x41) & (data <= 0x5A) & ordinary] += 32
        low[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97) & ordinary] += 32
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & ordinary[1:] & (kind[1:] != _SPACE)
        cut[start] = True
        first = np.flatnonzero(cut[:-1])
        close = cut.copy()
        close[end] = True
        closed = np.flatnonzero(close)
        last = closed[np.searchsorted(closed, first, side="right")] if len(first) else first
        return low, first, last, ~ordinary[first] if len(first) else np.zeros(0, bool), np.searchsorted(first, at)

    def ids(self, data: np.ndarray, at: np.ndarray, closing: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each closed by one more id, and the offsets of the texts."""
        low, start, end, strange, row = self._pieces(data, at)
        number, stand = distinct(low, start, end)
        size = (end - start)[stand]
        kept = np.flatnonzero(~strange[stand])
        order = kept[np.argsort(size[kept], kind="stable")]
        tables, counts, which = [], [], []
        at_cell = 0
        while at_cell < len(order):
            width = int(size[order[at_cell]])
            stop = at_cell + max(1, CELLS // max(width, 1))
            own = order[at_cell : min(stop, int(np.searchsorted(size[order], width, side="right")))]
            made, count = self.merges.merge(low, start[stand[own]], size[own])
            tables.append(made)
            counts.append(count)
            which.append(own)
            at_cell += len(own)
        others = np.flatnonzero(strange[stand])
        if len(others):
            raw = low.tobytes()
            made = self._library([raw[a:b] for a, b in zip(start[stand[others]].tolist(), end[stand[others]].tolist(), strict=True)])
            tables.append(np.concatenate(made))
            counts.append(np.array([len(m) for m in made]))
            which.append(others)
        # The closing id is one more piece at the end of the table, put after each text.
        table = np.concatenate([*tables, np.array([closing])]).astype(np.uint32)
        which = np.concatenate([*which, [len(stand)]]).astype(np.int64)
        count = np.concatenate([*counts, [1]]).astype(np.int64)
        place, many = np.empty(len(which), np.int64), np.empty(len(which), np.int64)
        place[which], many[which] = np.cumsum(count) - count, count
        units = np.insert(number, row[1:], len(stand))
        taken = many[units]
        out = table[spans(place[units], taken)]
        ends = np.cumsum(taken)[row[1:] + np.arange(len(at) - 1)]
        return out, np.concatenate(([0], ends)).astype(np.int64)
