"""Ranked lexical search: the best documents for each of a set of query texts.

Every document folds the impacts of its terms into a sketch: terms are hashed to WIDTH
coordinates, and a coordinate keeps the largest impact that falls on it. The queries of a block
look their terms up in the sketches of a batch of documents at once, as one matrix product; the
sum is an upper bound of the score, since no term's impact exceeds its coordinate. Documents are
then scored exactly by descending bound, until the bound falls below the score of the last of the
k best known to the task. Each task hands on its k best documents for each query, which Spark
ranks in two rounds.

A first pass over the documents counts what weights need: documents and terms in all, and the
documents that hold each query term. Query texts are read in blocks of at most BLOCK_ITEMS items
and about BLOCK_BYTES of text, so what a task holds of them is bounded; documents are read as they
lie, with no shuffle. Terms meet by 64-bit hashes, and every hit is compared with the query term
on bytes, so that scores are exact.

Results. Null texts, empty ones and texts without terms never match; a query without terms, or
whose terms stand nowhere, has no rows. Repeated rows are documents of their own; of equal scores
the smaller doc_id goes first and a null id last. Repeated item ids are answered each on its own.
Empty tables give an empty result. Texts are read whole, and other columns never. A document is
held by its task whole, at about 100 bytes a term.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patio.llm.common import id_text, in_pieces, utf8
from patio.llm.words import _BYTE, _FACTOR, _INVERSE, _powers, spans

TOP = 20
#: Coordinates of a sketch, a power of two.
WIDTH = 4096
#: Queries that one pass answers.
BLOCK_ITEMS = 1024
BLOCK_BYTES = 4 << 20
#: Text and rows held by a task at a time; a longer text comes alone.
BATCH_BYTES = 1 << 20
BATCH_ROWS = 512
#: Documents scored before the bound is looked at again.
STEP = 32
#: Parts of the first round of ranking.
PARTS = 64
HITS = "item long, doc_id long, score long"

# Fixed values of the score.
SCALE, GAIN, LOAD = 1_000_000_000, 1000, 12
FLAT, SLOPE, WEIGHT = 75, 25, 1000

_TERM = np.zeros(256, bool)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    _TERM[ord(_low) : ord(_high) + 1] = True
_TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Terms(NamedTuple):
    """The terms of a batch: lower-case bytes, and of each term its place, row and hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    code: np.ndarray


def terms_of(data: np.ndarray, at: np.ndarray) -> Terms:
    """Runs of ASCII letters, digits and bytes of other characters; A-Z become a-z."""
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    inside = np.concatenate(([False], _TERM[data], [False]))
    begins = inside[1:-1] & (~inside[:-2] | edge[:-1])
    ends = inside[1:-1] & (~inside[2:] | edge[1:])
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    low = _LOWER[data]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[low] * _powers(int(_FACTOR), len(low)), dtype=np.uint64)))
    code = (sums[end] - sums[start]) * _powers(_INVERSE, len(low) + 1)[start]
    return Terms(low, start, end, np.searchsorted(at, start, side="right") - 1, code)


def coordinate(code: np.ndarray) -> np.ndarray:
    return ((code * _FACTOR) >> np.uint64(64 - WIDTH.bit_length() + 1)).astype(np.int64)


class Queries:
    """A block of query texts: their distinct terms and how often each query has each."""

    def __init__(self, texts: list[str]):
        data, at = utf8(pa.array(texts, pa.string()))
        found = terms_of(data, at)
        raw = found.data.tobytes()
        self.number: dict[bytes, int] = {}
        held: list[dict[int, int]] = [{} for _ in texts]
        for row, a, b in zip(found.row.tolist(), found.start.tolist(), found.end.tolist(), strict=True):
            term = self.number.setdefault(raw[a:b], len(self.number))
            held[row][term] = held[row].get(term, 0) + 1
        self.terms = [np.array(list(h), np.int64) for h in held]
        self.times = [np.array(list(h.values()), np.int64) for h in held]
        size = np.array([len(t) for t in self.number], np.int64)
        self.data = np.frombuffer(b"".join(self.number), np.uint8)
        self.end = np.cumsum(size)
        self.start = self.end - size
        # Terms are closed by an edge each, so that they stay apart.
        own = terms_of(self.data, np.concatenate(([0], self.end)))
        self.at = coordinate(own.code)
        self.code, self.first = np.unique(own.code, return_index=True)

    def find(self, found: Terms) -> np.ndarray:
        """The number of the query term that each term is, or -1."""
        if not len(self.code) or not len(found.code):
            return np.full(len(found.code), -1)
        near = np.minimum(np.searchsorted(self.code, found.code), len(self.code) - 1)
        hit = np.flatnonzero(self.code[near] == found.code)
        term = self.first[near[hit]]
        size, other = found.end[hit] - found.start[hit], self.end[term] - self.start[term]
        wrong = size != other
        same = np.flatnonzero(~wrong)
        differ = found.data[spans(found.start[hit[same]], size[same])] != self.data[spans(self.start[term[same]], size[same])]
        wrong[np.repeat(same, size[same])[differ]] = True
        number = np.full(len(found.code), -1)
        number[hit] = term
        for k in hit[wrong].tolist():
            number[k] = self.number.get(found.data[found.start[k] : found.end[k]].tobytes(), -1)
        return number


class Batch(NamedTuple):
    """Distinct terms of each row: row, number of the query term or -1, coordinate and count."""

    row: np.ndarray
    number: np.ndarray
    at: np.ndarray
    tf: np.ndarray
    #: Terms of each row, with repeats.
    n: np.ndarray


def counted(queries: Queries, column: pa.Array) -> Batch:
    data, at = utf8(column)
    found = terms_of(data, at)
    number = queries.find(found)
    # Query terms are told apart by their number, all others by their hash.
    name = np.where(number >= 0, number.astype(np.uint64), found.code | np.uint64(1 << 63))
    order = np.lexsort((name, found.row))
    row, name = found.row[order], name[order]
    new = np.ones(len(order), bool)
    new[1:] = (row[1:] != row[:-1]) | (name[1:] != name[:-1])
    first = np.flatnonzero(new)
    tf = np.diff(np.append(first, len(order)))
    lead = order[first]
    n = np.bincount(found.row, minlength=len(column)).astype(np.int64)
    return Batch(row[first], number[lead], coordinate(found.code[lead]), tf.astype(np.int64), n)


class Corpus(NamedTuple):
    """Documents with a term, terms of all documents, and documents that hold each query term."""

    documents: int
    terms: int
    holding: dict[int, int]

    def weight(self, number: int) -> int:
        return math.floor(WEIGHT * math.log((2 * self.documents + 2) / (2 * self.holding.get(number, 0) + 1)))


class Scorer:
    """The best documents of a task for every query of a block."""

    def __init__(self, queries: Queries, corpus: Corpus, k: int):
        self.queries, self.corpus, self.k = queries, corpus, k
        weight = np.array([corpus.weight(t) for t in range(len(queries.number))], np.int64)
        self.weights = [weight[t] * times for t, times in zip(queries.terms, queries.times, strict=True)]
        self.matrix = np.zeros((WIDTH, len(queries.terms)))
        for q, (terms, own) in enumerate(zip(queries.terms, self.weights, strict=True)):
            np.add.at(self.matrix[:, q], queries.at[terms], own)
        self.best: list[list[tuple[int, int | None]]] = [[] for _ in queries.terms]
        self.least = np.ones(len(queries.terms))
        self.scored = 0

    def add(self, ids: list[int | None], batch: Batch) -> None:
        m = FLAT + SLOPE * batch.n * self.corpus.documents // max(self.corpus.terms, 1)
        impact = SCALE * batch.tf // (GAIN * batch.tf + LOAD * m[batch.row])
        sketch = np.zeros((len(ids), WIDTH))
        np.maximum.at(sketch, (batch.row, batch.at), impact)
        # Sums of whole numbers below 2^53 are exact; the margin covers longer ones.
        bound = (sketch @ self.matrix) * (1 + 1e-9)
        known = batch.number >= 0
        places = len(self.queries.number)
        key = batch.row[known] * places + batch.number[known]
        order = np.argsort(key)
        key, impact = np.append(key[order], -1), np.append(impact[known][order], 0)
        for q in np.flatnonzero((bound >= self.least).any(axis=0)).tolist():
            rows = np.flatnonzero(bound[:, q] >= self.least[q])
            rows = rows[np.argsort(-bound[rows, q], kind="stable")]
            for at in range(0, len(rows), STEP):
                part = rows[at : at + STEP]
                if bound[part[0], q] < self.least[q]:
                    break
                self._keep(q, [ids[r] for r in part.tolist()], self._scores(q, part, key, impact, places))

    def _scores(self, q: int, rows: np.ndarray, key: np.ndarray, impact: np.ndarray, places: int) -> np.ndarray:
        wanted = rows[:, None] * places + self.queries.terms[q]
        at = np.searchsorted(key[:-1], wanted)
        self.scored += len(rows)
        return np.where(key[at] == wanted, impact[at], 0) @ self.weights[q]

    def _keep(self, q: int, ids: list[int | None], scores: np.ndarray) -> None:
        found = [(s, i) for s, i in zip(scores.tolist(), ids, strict=True) if s >= self.least[q]]
        if found:
            best = sorted(self.best[q] + found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[: self.k]
            self.best[q] = best
            if len(best) == self.k:
                self.least[q] = best[-1][0]

    def rows(self) -> pa.RecordBatch:
        flat = [(q, i, s) for q, best in enumerate(self.best) for s, i in best]
        columns = zip(*flat, strict=True) if flat else ((), (), ())
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches, BATCH_BYTES):
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def corpus_counts(docs: DataFrame, queries: Queries) -> Corpus:
    """One pass over all documents; at most one row for each query term comes back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, terms = np.zeros(len(queries.number), np.int64), 0, 0
        for batch in _batches(batches):
            found = counted(queries, batch.column("text"))
            holding += np.bincount(found.number[found.number >= 0], minlength=len(holding))
            documents += int((found.n > 0).sum())
            terms += int(found.n.sum())
        held = np.flatnonzero(holding)
        names, counts = np.append(held, [-1, -2]), np.append(holding[held], [documents, terms])
        yield pa.record_batch([pa.array(names, pa.int64()), pa.array(counts, pa.int64())], names=["term", "n"])

    sums = dict(docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    return Corpus(sums.pop(-1, 0), sums.pop(-2, 0), sums)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Query texts in blocks, one partition of the table at a time."""
    block, size = [], 0
    for row in items.select(F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit(""))).toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(row[1]) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


def _best(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents with a score above 0 of every item."""
    spark, rows = docs.sparkSession, id_text(docs)
    answers = None
    for block in _blocks(items):
        queries = Queries([text for _, text in block])
        shared = spark.sparkContext.broadcast((queries, corpus_counts(rows, queries)))

        def rank(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries, corpus = shared.value
            scorer = Scorer(queries, corpus, k)
            for batch in _batches(batches):
                scorer.add(batch.column("doc_id").to_pylist(), counted(queries, batch.column("text")))
            yield scorer.rows()

        part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
        hits = rows.mapInArrow(rank, HITS).withColumn("part", part)
        best = _best(_best(hits, ["item", "part"], k).drop("rank"), ["item"], k)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        named = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        answers = named if answers is None else answers.unionByName(named)
    if answers is None:
        answers = spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    return answers
