"""SimHash near-dedup over a Gray-order hierarchical index.

A document's fingerprint is the bitwise majority over the hashes of its word shingles. Distinct
fingerprints that differ in at most MAX_BITS of 64 bits are linked, and a component is what
links reach.

Candidates: 64 bits are four blocks of 16, and two fingerprints within three bits agree in one
of them, so each fingerprint goes to four keys (block, value). Keys with more than HOT_ROWS
fingerprints are dealt once more: their other 48 bits are four blocks of 12, and again one of
them agrees. No pair is lost by this. A task sorts its fingerprints by key and Gray rank, and
builds a tree over each key's run: a node holds the bits that all its fingerprints share (mask
and pattern) and FANOUT children. The search goes down pairs of nodes together. Bits in which
two shared patterns differ count against every pair below, so pairs of groups beyond the limit
are cut off whole; pairs of groups that cannot differ in more than the limit are linked whole,
without listing their members. A task emits a spanning forest of its links, not the pairs.

keep_one drops near copies by these components: the document with the smallest id of each stays.

Defined cases: null text counts as empty; a text without words has fingerprint zero and is
linked like any other. Rows with null doc_id get a fingerprint but take no part in links, their
component is null. Rows with one doc_id are one document for links. Repeated rows get a row
each. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.common import id_text, stored, utf8

MAX_BITS = 3
SHINGLE = 3
SEED = 42
FANOUT = 8
HOT_ROWS = 20_000
#: Node pairs that are looked at together.
FRONTIER = 1 << 18


def fingerprint(raw: bytes) -> int:
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-1])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=False)]
    votes = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = votes.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column("text"))
            raw = data.tobytes()
            made = [fingerprint(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.int64())], names=["doc_id", "fp"]
            )

    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Union of row numbers by smallest label; links come in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(self.root, high, low)

    def find(self, a: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[a]
            above = self.root[up]
            if (up == above).all():
                return up
            self.root[a] = above
            a = above


def linked_rows(key: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For rows sorted by key and Gray rank: the first row each is linked to within its key."""
    n = len(key)
    forest = Forest(n)
    # Level 0 is the rows; each level above joins FANOUT neighbours of one key.
    levels = [(np.full(n, ~np.uint64(0)), code.copy(), np.arange(n), np.arange(n), key)]
    while True:
        mask, pattern, first, last, own = levels[-1]
        run = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        place = np.arange(len(own)) - np.repeat(run, np.diff(np.append(run, len(own))))
        start = np.flatnonzero(place % FANOUT == 0)
        stop = np.append(start[1:], len(own))
        if len(start) == len(own):
            break
        ones = np.bitwise_and.reduceat(mask & pattern, start)
        zeros = np.bitwise_and.reduceat(mask & ~pattern, start)
        levels.append((ones | zeros, ones, start, stop - 1, own[start]))
    # At the top every key has one node; go down pairs (i, j) with i <= j.
    top = len(levels) - 1
    whole = np.arange(len(levels[top][4]))
    stack = [(top, whole[k : k + FRONTIER], whole[k : k + FRONTIER], np.zeros(len(whole[k : k + FRONTIER]), np.int64), np.zeros(len(whole[k : k + FRONTIER]), np.uint64)) for k in range(0, len(whole), FRONTIER)]
    spans = []  # rows (first, last) under each node, by level
    low = high = np.arange(n)
    spans.append((low, high))
    for mask, pattern, first, last, own in levels[1:]:
        low, high = low[first], high[last]
        spans.append((low, high))
    while stack:
        level, i, j, differ, counted = stack.pop()
        mask, pattern, first, last, _ = levels[level]
        shared = mask[i] & mask[j]
        # Differences add up on the way down: only bits newly shared at this level are counted.
        differ = differ + np.bitwise_count((pattern[i] ^ pattern[j]) & shared & ~counted)
        near = differ <= MAX_BITS
        i, j, differ, shared = i[near], j[near], differ[near], shared[near]
        low, high = spans[level]
        at_i, at_j = low[i], low[j]
        open_bits = np.bitwise_count(~shared).astype(np.int64)
        whole_near = differ + open_bits <= MAX_BITS
        if level == 0:
            forest.add(at_i, at_j)
            continue
        if whole_near.any():
            a, b = i[whole_near], j[whole_near]
            heads = np.concatenate((np.repeat(low[a], high[a] - low[a] + 1), np.repeat(low[a], high[b] - low[b] + 1)))
            rows = np.concatenate((_ranges(low[a], high[a]), _ranges(low[b], high[b])))
            forest.add(heads, rows)
        i, j, differ, shared = i[~whole_near], j[~whole_near], differ[~whole_near], shared[~whole_near]
        if len(i) > n // 8:
            # Pairs of nodes whose rows are all connected already need no further look.
            root = forest.find(np.arange(n))
            least, most = np.minimum.reduceat(root, low), np.maximum.reduceat(root, low)
            done = (least[i] == most[i]) & (least[j] == most[j]) & (least[i] == least[j])
            i, j, differ, shared = i[~done], j[~done], differ[~done], shared[~done]
        if len(i):
            n_i, n_j = last[i] - first[i] + 1, last[j] - first[j] + 1
            times = n_i * n_j
            pair = np.repeat(np.arange(len(i)), times)
            turn = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
            down_i = first[i][pair] + turn // n_j[pair]
            down_j = first[j][pair] + turn % n_j[pair]
            one = (down_i < down_j) | ((down_i == down_j) & (level > 1))
            down = (down_i[one], down_j[one], differ[pair][one], shared[pair][one])
            for k in range(0, len(down[0]), FRONTIER):
                stack.append((level - 1, *(x[k : k + FRONTIER] for x in down)))
    return forest.find(np.arange(n))


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    size = high - low + 1
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)


def _forest_edges(batches):
    """Links of all keys in the partition, one edge for each row that joins another."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    key = table.column("key").to_numpy()
    code = table.column("fp").to_numpy().view(np.uint64)
    node = table.column("node").to_numpy()
    order = np.lexsort((gray_rank(code), key))
    key, code, node = key[order], code[order], node[order]
    head = linked_rows(key, code)
    joined = node[head] != node
    yield pa.RecordBatch.from_arrays([pa.array(node[joined]), pa.array(node[head][joined])], names=["a", "b"])


def _block(bits: int, at: int):
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << bits) - 1))


def edges(points: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of points (fp, node), enough to connect what is connected."""
    keys = F.array(*[F.lit(b << 16) + _block(16, 16 * b) for b in range(4)])
    rows = points.select("fp", "node", F.explode(keys).alias("key"))
    hot = stored(rows.groupBy("key").count().where(F.col("count") > HOT_ROWS).select("key"))
    if hot.isEmpty():
        dealt = rows
    else:
        finer = []
        for block in range(4):
            others = [b for b in range(4) if b != block]
            rest = F.lit(0).cast("long")
            for place, b in enumerate(others):
                rest = rest.bitwiseOR(F.shiftleft(_block(16, 16 * b), 16 * place))
            parts = [
                F.lit((k + 1) << 32) + F.shiftleft(F.col("key"), 36) + F.shiftrightunsigned(rest, 12 * k).bitwiseAND(F.lit(0xFFF))
                for k in range(4)
            ]
            finer.append(F.when(F.shiftrightunsigned("key", 16) == block, F.array(*parts)))
        heavy = rows.join(hot, "key", "left_semi").select("fp", "node", F.explode(F.coalesce(*finer)).alias("key"))
        dealt = rows.join(hot, "key", "left_anti").select("fp", "node", "key").unionByName(heavy)
    return dealt.repartition("key").select("key", "fp", "node").mapInArrow(_forest_edges, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and the smallest node it reaches, for every node of links that has a smaller one.

    Large-star and small-star rounds: each node's larger (then smaller) neighbours move to its
    smallest one, until every edge points at a root.
    """
    links = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    )
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct())
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(root, "u")
        small = (
            moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(root.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct()
        )
        small = stored(small)
        before, after = (x.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (links, small))
        if before == after:
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        links = small


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    made = stored(fingerprints(docs))
    points = stored(made.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    # Ids with several texts tie their fingerprints together.
    several = made.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low != high")
    ties = made.join(several.select("doc_id"), "doc_id").join(points, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    roots = components(edges(points).unionByName(ties))
    named = points.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return made.join(named, "fp").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    ).unionByName(
        made.where("doc_id is null").join(points, "fp", "left_anti").select("doc_id", "fp", F.lit(None).cast("long").alias("component_id"))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its group of near copies; columns as in docs.

    Rows with null doc_id stay. Of rows repeated with one doc_id, the one with the smallest text stays.
    """
    heads = near_groups(docs).where("doc_id = component_id")
    stays = stored(heads.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")))
    # Rows travel as one column, so that no name of theirs can clash.
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    joined = keyed.join(stays, "doc_id")
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    most = joined.where("copies > 1").withColumn("text", text)
    first = most.groupBy("doc_id").agg(F.min("text").alias("text"))
    repeated = most.join(first, ["doc_id", "text"]).dropDuplicates(["doc_id"])
    kept = joined.where("copies = 1").select("row.*").unionByName(repeated.select("row.*"))
    return kept.unionByName(docs.where("doc_id is null"))
