"""SentencePiece encoding and decoding with a batched Viterbi search.

The segmentation of a text is the one with the largest sum of piece scores, as in the unigram
model, over the pieces and scores of the model file; characters without a piece become byte
pieces. The public file holds pieces of a merging model, whose scores are falling ranks, so its
ids here are those of the library when it reads the same file as a unigram model, not those of
merging. Of equal sums the longer last piece wins, as in the library.

No piece has a blank behind another character, so a text is cut before each run of blanks and
each distinct part of a batch is searched once. Parts of equal length advance together: hashes
of all substrings of a length probe the sorted piece keys at once, hits are compared byte by
byte, and for each place the maxima over all parts are stored with their backpointers.

Defined cases: null text counts as empty and has no ids. The sign U+2581 stands for a blank in
the model, so a text that holds it comes back with a blank, as in the library; every other text
comes back whole. Repeated rows get a row each. Long parts are searched in blocks, and memory
grows with the part, not with the number of pieces. Other columns are not read. An empty table
gives an empty result. The model must normalise by identity; others are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.common import id_text, in_pieces, utf8
from patio.llm.words import distinct, spans

BATCH_BYTES = 2 << 20
BATCH_IDS = 1 << 18
#: Cells of the matrix of one block.
CELLS = 1 << 17
#: Places that a block of one long part covers.
BLOCK = 1 << 13
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(31).integers(1, 1 << 63, 256, dtype=np.uint64)
_MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _hash(rows: np.ndarray) -> np.ndarray:
    """Hash of each row of bytes, left to right."""
    out = np.full(len(rows), rows.shape[1], np.uint64)
    for k in range(rows.shape[1]):
        out = (out + _BYTE[rows[:, k]]) * _FACTOR
    return out ^ (out >> np.uint64(29))


class Model:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rule = proto.normalizer_spec
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces:
            raise ValueError("only models that normalise by identity are supported")
        self.prefix = rule.add_dummy_prefix
        kinds = type(proto.pieces[0]).Type
        normal, single = kinds.Value("NORMAL"), kinds.Value("BYTE")
        pieces = [(k, p.piece.replace(_MARK, " ").encode(), p.score) for k, p in enumerate(proto.pieces) if p.type == normal]
        if any(b" " in raw.lstrip(b" ") for _, raw, _ in pieces):
            raise ValueError("a piece has a blank inside")
        self.byte_ids = np.full(256, -1, np.int64)
        for k, p in enumerate(proto.pieces):
            if p.type == single:
                self.byte_ids[int(p.piece[3:5], 16)] = k
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        self.unknown = min(score for *_, score in pieces) - 10.0
        self.longest = max(len(raw) for _, raw, _ in pieces)
        self.by_size = {}
        for size in range(1, self.longest + 1):
            own = [(k, raw, score) for k, raw, score in pieces if len(raw) == size]
            if own:
                raw = np.frombuffer(b"".join(r for _, r, _ in own), np.uint8).reshape(-1, size)
                key = _hash(raw)
                order = np.argsort(key)
                mask = np.zeros(1 << 16, bool)
                mask[(key & np.uint64(0xFFFF)).astype(np.int64)] = True
                self.by_size[size] = (
                    key[order], raw[order], np.array([k for k, *_ in own], np.int64)[order], np.array([s for *_, s in own])[order], mask
                )
        # Bytes of every id, for decoding.
        out = [b""] * len(proto.pieces)
        for k, raw, _ in pieces:
            out[k] = raw
        for b, k in enumerate(self.byte_ids.tolist()):
            out[k] = bytes([b])
        self.bytes = np.frombuffer(b"".join(out), np.uint8)
        self.size = np.array([len(x) for x in out], np.int64)
        self.place = np.cumsum(self.size) - self.size

    # --- encoding -----------------------------------------------------------------------------

    def _matches(self, rows: np.ndarray, first: int, stop: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Score and id of the piece of each length at each place first..stop; -inf where none."""
        found = {}
        n, width = rows.shape
        code = np.zeros((n, stop - first), np.uint64)
        for size in range(1, min(self.longest, width - first) + 1):
            span = min(stop, width - size + 1) - first
            if span <= 0:
                break
            # The hash of a longer substring continues that of the shorter one at the same place.
            code = (code[:, :span] + _BYTE[rows[:, first + size - 1 : first + size - 1 + span]]) * _FACTOR
            if size not in self.by_size:
                continue
            keys, raw, ids, scores, mask = self.by_size[size]
            full = code + _SEEDS[size]
            full ^= full >> np.uint64(29)
            row, at = np.nonzero(mask[(full & np.uint64(0xFFFF)).astype(np.int64)])
            if not len(row):
                continue
            probe = full[row, at]
            hit = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
            same = keys[hit] == probe
            row, at, hit = row[same], at[same], hit[same]
            equal = (rows[row[:, None], first + at[:, None] + np.arange(size)] == raw[hit]).all(axis=1)
            row, at, hit = row[equal], at[equal], hit[equal]
            if len(row):
                score, name = np.full((n, span), -np.inf), np.full((n, span), -1, np.int64)
                score[row, at], name[row, at] = scores[hit], ids[hit]
                found[size] = (score, name)
        return found

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of one length (rows of bytes), end to end, and how many each has."""
        n, width = rows.shape
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0.0
        size_back = np.zeros((n, width + 1), np.int32)
        name_back = np.full((n, width + 1), -1, np.int32)
        lead = (rows & 0xC0) != 0x80
        length = np.select([rows < 0x80, rows < 0xE0, rows < 0xF0], [1, 2, 3], 4)
        for first in range(0, width, BLOCK):
            stop = min(first + BLOCK, width)
            found = self._matches(rows, first, stop)
            alone = np.zeros((n, stop - first), bool)
            for size in (1, 2, 3, 4):
                if size in found:
                    score, _ = found[size]
                    alone[:, : score.shape[1]] |= (score > -np.inf) & (length[:, first : first + score.shape[1]] == size)
            lost = lead[:, first:stop] & ~alone
            used = {size: (score > -np.inf).any(axis=0) for size, (score, _) in found.items()}
            any_lost = lost.any(axis=0)
            for at in range(stop - first):
                i = first + at
                here = best[:, i]
                for size, (score, name) in found.items():
                    if at < score.shape[1] and used[size][at]:
                        value = here + score[:, at]
                        better = value > best[:, i + size]
                        best[better, i + size] = value[better]
                        size_back[better, i + size] = size
                        name_back[better, i + size] = name[better, at]
                if any_lost[at]:
                    own = np.flatnonzero(lost[:, at])
                    to = i + length[own, i]
                    value = here[own] + self.unknown
                    better = value > best[own, to]
                    own, to = own[better], to[better]
                    best[own, to], size_back[own, to], name_back[own, to] = value[better], length[own, i], -1
        # Back from the end, all parts together; an unknown character gives its bytes.
        taken = np.zeros((n, width), np.int64) - 1
        at = np.full(n, width)
        live = np.arange(n)
        while len(live):
            size, name = size_back[live, at[live]], name_back[live, at[live]]
            begin = at[live] - size
            known = name >= 0
            taken[live[known], begin[known]] = name[known]
            for k in range(4):
                wide = ~known & (size > k)
                rows_, cols = live[wide], begin[wide] + k
                taken[rows_, cols] = self.byte_ids[rows[rows_, cols]]
            at[live] = begin
            live = live[begin > 0]
        return taken[taken >= 0], (taken >= 0).sum(axis=1)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of the texts."""
        data, at = _prepared(data, at, self.prefix)
        blank = data == 0x20
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = blank[1:] & ~blank[:-1]
        cut[at] = True
        edges = np.flatnonzero(cut)
        start, end = edges[:-1], edges[1:]
        number, stand = distinct(data, start, end)
        size = (end - start)[stand]
        order = np.argsort(size, kind="stable")
        tables, counts, k = [], [], 0
        while k < len(order):
            width = int(size[order[k]])
            stop = min(k + max(1, CELLS // width), int(np.searchsorted(size[order], width, side="right")))
            own = order[k:stop]
            made, count = self.search(data[start[stand[own]][:, None] + np.arange(width)])
            tables.append(made)
            counts.append(count)
            k = stop
        table = np.concatenate(tables) if tables else np.zeros(0, np.int64)
        count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        place, many = np.empty(len(stand), np.int64), np.empty(len(stand), np.int64)
        place[order], many[order] = np.cumsum(count) - count, count
        taken = many[number]
        ids = table[spans(place[number], taken)]
        first = np.searchsorted(start, at)
        return ids, np.concatenate(([0], np.cumsum(taken)))[first]

    # --- decoding -----------------------------------------------------------------------------

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts of ids end to end, and the offsets of the texts."""
        size = self.size[ids]
        data = self.bytes[spans(self.place[ids], size)]
        edge = np.concatenate(([0], np.cumsum(size)))[at]
        if not self.prefix:
            return data, edge
        full = edge[1:] > edge[:-1]
        keep = np.ones(len(data), bool)
        keep[edge[:-1][full]] = False
        return data[keep], edge - np.concatenate(([0], np.cumsum(full)))


#: What the length that a hash starts with has become after that many steps.
_SEEDS = np.array([k * pow(int(_FACTOR), k, 1 << 64) % (1 << 64) for k in range(256)], np.uint64)


def _prepared(data: np.ndarray, at: np.ndarray, prefix: bool) -> tuple[np.ndarray, np.ndarray]:
    """U+2581 is a blank; a text that is not empty gets one in front."""
    if len(data) > 2:
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        if len(mark):
            data = data.copy()
            data[mark] = 0x20
            keep = np.ones(len(data), bool)
            keep[mark + 1] = keep[mark + 2] = False
            at = np.concatenate(([0], np.cumsum(keep)))[at]
            data = data[keep]
    if not prefix:
        return data, at
    full = at[1:] > at[:-1]
    return np.insert(data, at[:-1][full], 0x20), at + np.concatenate(([0], np.cumsum(full)))


_models: dict[str, Model] = {}


def _model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _listed(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text_sha256 (of the text as read) and ids of every row."""
    path = path or default_model()

    def run(batches):
        for batch in in_pieces(batches, BATCH_BYTES):
            ids, at = _model(path).encode(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_sha256"), _listed(ids, at)], names=["doc_id", "text_sha256", "ids"]
            )

    rows = id_text(docs).select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"), "text")
    return rows.mapInArrow(run, "doc_id long, text_sha256 string, ids array<int>")


def _few_ids(batches):
    """Cut batches so that one piece holds about BATCH_IDS ids, or a single row."""
    for batch in batches:
        at, first = batch.column("ids").offsets.to_numpy().astype(np.int64), 0
        while first < batch.num_rows:
            last = int(np.searchsorted(at, at[first] + BATCH_IDS, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of encoded with the text that `ids` stand for."""
    path = path or default_model()
    names = encoded.columns

    def run(batches):
        for batch in _few_ids(batches):
            lists = batch.column("ids")
            at = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy()[at[0] : at[-1]]
            data, edge = _model(path).decode(ids, at - at[0])
            text = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(edge.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), text.cast(pa.string())], names=[*names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, text string")
