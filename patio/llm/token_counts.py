"""Token counts of whole texts under a byte-level pair-merging vocabulary.

A text is cut into pre-tokens, and most pre-tokens are themselves vocabulary strings. Which
vocabulary strings come out as a single token when they are merged alone is proved once, on the
driver, by merging every one of them (`prove_whole`); the proved strings are broadcast, at most as
many as the vocabulary has. A task then counts a pre-token that is among them as one token
without merging it, and merges only the rest, each distinct one once while it is remembered.

Results. Null text counts as empty: 0 bytes, 0 tokens. Special strings of the vocabulary file
(`<|endoftext|>`) are one token each wherever they stand, as is the library's default. Texts of
any length are counted whole; the cuts of a long text into windows lie between two pre-tokens.
Rows repeat as they are, also with a null id; an empty table gives an empty result; other columns
are never read.
"""

from __future__ import annotations

import functools
import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patio.llm.bpe import Merges, _byte_signs
from patio.llm.common import id_text, in_pieces

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
#: Text held by a task at a time; a longer text comes alone and is cut into windows.
BATCH_BYTES = 1 << 20
WINDOW = 1 << 19
#: Merged pre-tokens that a worker remembers between windows.
REMEMBERED = 200_000
#: Longer pre-tokens are merged one by one, over a queue.
LONGEST = 64
#: Cells of one merging matrix.
CELLS = 1 << 18
#: A blank between two other characters always begins a pre-token.
_CUT = regex.compile(r"(?<=[^\s]) (?=[^\s])")


class Merger:
    """Number of tokens that a byte string merges to: best rank first, the leftmost of equals."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cutter = spec["model"], spec["pre_tokenizer"]
        plain = cutter["type"] == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]
        odd = [model[k] for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout") if model.get(k)]
        if model["type"] != "BPE" or not plain or spec["normalizer"] or odd or model.get("ignore_merges"):
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        if any(token[f] for token in spec["added_tokens"] for f in flags):
            raise ValueError("added tokens that strip or need word ends are not supported")
        self.special = [token["content"] for token in spec["added_tokens"]]
        vocab, signs = model["vocab"], _byte_signs()
        code = {sign: byte for byte, sign in enumerate(signs)}
        self.strings = [bytes(map(code.__getitem__, v)) for v in vocab if all(c in code for c in v)]
        self.first = [vocab[c] for c in signs]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rules = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}

    def count(self, piece: bytes) -> int:
        """A queue of pairs by rank over a linked list, so that long pieces stay cheap."""
        rules, token = self.rules, [self.first[b] for b in piece]
        size = len(token)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        queue = []
        for at in range(size - 1):
            if rule := rules.get((token[at], token[at + 1])):
                queue.append((rule[0], at, rule[1]))
        heapq.heapify(queue)
        left = size
        while queue:
            rank, at, made = heapq.heappop(queue)
            right = after[at]
            # The pair may have changed or gone since it was queued.
            if right >= size or token[at] is None or rules.get((token[at], token[right])) != (rank, made):
                continue
            token[at], token[right] = made, None
            left -= 1
            after[at] = follow = after[right]
            if follow < size:
                before[follow] = at
                if rule := rules.get((made, token[follow])):
                    heapq.heappush(queue, (rule[0], at, rule[1]))
            lead = before[at]
            if lead >= 0 and (rule := rules.get((token[lead], made))):
                heapq.heappush(queue, (rule[0], lead, rule[1]))
        return left


@functools.cache
def merger(path: str) -> Merger:
    return Merger(path)


def prove_whole(path: str = VOCABULARY) -> frozenset[str]:
    """The vocabulary strings that merge to one token when they stand alone, as text.

    Strings that are no text by themselves (parts of a character) are never a whole pre-token.
    """
    rules = merger(path)
    whole = set()
    for string in rules.strings:
        if rules.count(string) == 1:
            try:
                whole.add(string.decode())
            except UnicodeDecodeError:
                continue
    return frozenset(whole)


class PreTokens:
    """Cuts text as the library does.

    A pattern cuts texts of characters whose kind has been settled since Unicode 3.2. Windows
    with a later character are cut by the library, whose tables need not be those of `regex`.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.unsettled = _unsettled()

    def cut(self, text: str) -> list[str]:
        if text.isascii() or not self.unsettled[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]


@functools.cache
def _unsettled() -> np.ndarray:
    """For each code point whether Unicode 3.2 had not assigned it."""
    kind = unicodedata.ucd_3_2_0.category
    return np.array([kind(chr(code)) == "Cn" for code in range(sys.maxunicode + 1)])


@functools.cache
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """The text in parts of about `size` characters, cut where a pre-token surely begins."""
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


class PairTable(Merges):
    """The merging rules as sorted arrays, for many pieces of one size at a time."""

    def __init__(self, rules: Merger):
        pairs = np.array(list(rules.rules), np.int64).reshape(-1, 2)
        made = np.array(list(rules.rules.values()), np.int64).reshape(-1, 2)
        key = (pairs[:, 0] << 20) | pairs[:, 1]
        order = np.argsort(key)
        self.inner = self.last = np.array(rules.first, np.int64)
        self.key, self.rank, self.made = key[order], made[order, 0], made[order, 1]


@functools.cache
def pair_table(path: str) -> PairTable:
    return PairTable(merger(path))


class Counter:
    """Tokens of texts, and how many of these were counted without merging."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.whole, self.cutter = whole, pre_tokens(path)
        self.rules, self.table = merger(path), pair_table(path)
        self.known: dict[str, int] = {}
        special = self.rules.special
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokens, direct = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        held: list[tuple[int, list[str]]] = []
        size = 0
        for row, text in enumerate(texts):
            parts = self.special.split(text) if self.special else [text]
            tokens[row] += len(parts) - 1
            for window in (w for part in parts for w in windows(part)):
                pieces = self.cutter.cut(window)
                rest = [p for p in pieces if p not in self.whole]
                direct[row] += len(pieces) - len(rest)
                held.append((row, rest))
                size += len(window)
                if size >= WINDOW:
                    self._flush(held, tokens)
                    held, size = [], 0
        self._flush(held, tokens)
        return tokens + direct, direct

    def _flush(self, held: list[tuple[int, list[str]]], tokens: np.ndarray) -> None:
        """Merge the distinct new pieces and add up the windows."""
        new = {p for _, rest in held for p in rest if p not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = {p for _, rest in held for p in rest}
        self._merge(new)
        for row, rest in held:
            tokens[row] += sum(map(self.known.__getitem__, rest))

    def _merge(self, pieces: set[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for piece in pieces:
            by_size.setdefault(len(piece.encode()), []).append(piece)
        for size, same in by_size.items():
            if size > LONGEST:
                self.known.update((p, self.rules.count(p.encode())) for p in same)
                continue
            step = max(1, CELLS // size)
            for at in range(0, len(same), step):
                part = same[at : at + step]
                data = np.frombuffer("".join(part).encode(), np.uint8)
                _, counts = self.table.merge(data, np.arange(len(part)) * size, np.full(len(part), size))
                self.known.update(zip(part, counts.tolist(), strict=True))


def token_counts(docs: DataFrame, path: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_whole (tokens found without merging) of every text."""
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, whole.value)
        for batch in in_pieces(batches, BATCH_BYTES):
            tokens, direct = counter.count(batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens), pa.array(direct)],
                names=["doc_id", "n_bytes", "n_tokens", "n_whole"],
            )

    rows = id_text(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, n_whole long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_whole")
