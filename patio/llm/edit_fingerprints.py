"""Document fingerprints by a randomised edit embedding.

All texts are read by the same random walk: at step j the walk stands on a character and, by a
shared random bit for (j, character), stays or moves on. What it reads is the embedding. After an
insertion or deletion the walks of two texts soon fall in step again, so few edits change few
places: edit distance becomes Hamming distance. The fingerprint samples SAMPLES places. Places
are dealt to samples by hash and ranked at random; a sample is the best-ranked place that the
walk reaches, so texts of different lengths sample the same places as far as both go. A sample
keeps four bits of the character and is one hex digit, or '-' where the walk ends before it.

Likeness of two fingerprints is the share of equal samples among those that either has, less
what unlike texts share by chance. Candidates for a search agree in all samples of one of BANDS
bands (bit-sampled), and are verified by likeness.

The edited text of a document takes its end from the next one in descending doc_id order. Rows
are dealt by ranges of doc_id and sorted there; a range also gets the first document of the next
range, so whole texts are shuffled once.

Defined cases: null text counts as empty; an empty text has no sample at all, and two of them
are alike (1). Ties in doc_id are ordered by text, null ids come last; a table of one row is its
own next document. Repeated rows get a row each. Other columns are not read. An empty table
gives an empty result. Texts are walked in chunks of about CHUNK characters; one text is always
whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.common import id_text

SAMPLES = 128
BANDS = 16
BAND_SAMPLES = 4
LIKE = 0.8
#: Documents of one range, on average.
RANGE_ROWS = 4096
MOST_RANGES = 10_000
CHUNK = 8 << 20
#: The random bits repeat after so many steps.
PERIOD = 4096
END = 255

_BITS = np.random.default_rng(17).integers(0, 2, (PERIOD, 256), dtype=np.uint8)
_BITS[:, END] = 0
_NIBBLE = np.random.default_rng(23).permutation(256).astype(np.uint8) & 15
_HEX = np.frombuffer(b"0123456789abcdef-", np.uint8)
ABSENT = 16
_BAND = np.random.default_rng(29).permuted(np.tile(np.arange(SAMPLES), (BANDS, 1)), axis=1)[:, :BAND_SAMPLES]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Places:
    """Which sample takes a place: the places at which a sample's rank is the best so far."""

    def __init__(self):
        self.reach = 0
        self.best = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
        self.at: dict[int, int] = {}

    def upto(self, steps: int) -> dict[int, int]:
        while self.reach < steps:
            step = np.arange(self.reach, self.reach + (1 << 16), dtype=np.uint64)
            sample = (_mixed(step + np.uint64(1)) % np.uint64(SAMPLES)).astype(np.int64)
            # The first places fill all samples in turn, for short texts.
            early = step < SAMPLES
            sample[early] = step[early].astype(np.int64)
            rank = _mixed(step + np.uint64(0x9E3779B97F4A7C15))
            rank[early] = np.iinfo(np.uint64).max - np.uint64(1)
            for k in np.flatnonzero(rank < self.best[sample]).tolist():
                s = int(sample[k])
                if rank[k] < self.best[s]:
                    self.best[s] = rank[k]
                    self.at[self.reach + k] = s
            self.reach += 1 << 16
        return self.at


_places = Places()


def walk(texts: list[str]) -> np.ndarray:
    """Samples (text, sample) of the texts' embeddings, values 0 to 15 or ABSENT."""
    coded = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    codes = (((coded * np.uint32(2654435761)) >> np.uint32(13)) % np.uint32(END)).astype(np.uint8)
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1])).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    stop = start + size
    codes[stop] = END
    out = np.full((len(texts), SAMPLES), ABSENT, np.uint8)
    places = _places.upto(3 * int(size.max(initial=0)) + 1)
    live = np.flatnonzero(size > 0)
    at = start[live]
    step = 0
    while len(live):
        rows = _BITS[step % PERIOD]
        char = codes.take(at)
        sample = places.get(step)
        if sample is not None:
            inside = char != END
            out[live[inside], sample] = _NIBBLE[char[inside]]
        at += rows.take(char)
        step += 1
        if step % 128 == 0:
            inside = at < stop[live]
            live, at = live[inside], at[inside]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    either = (a != ABSENT) | (b != ABSENT)
    number = either.sum(axis=1)
    equal = ((a == b) & either).sum(axis=1) / np.maximum(number, 1)
    return np.where(number == 0, 1.0, np.clip((equal - 1 / 16) / (1 - 1 / 16), 0, 1))


def shown(samples: np.ndarray) -> list[str]:
    raw = _HEX[samples].tobytes().decode()
    return [raw[i : i + SAMPLES] for i in range(0, len(raw), SAMPLES)]


def read(fingerprints: list[str]) -> np.ndarray:
    back = np.zeros(256, np.uint8)
    back[_HEX] = np.arange(17)
    return back[np.frombuffer("".join(fingerprints).encode(), np.uint8)].reshape(-1, SAMPLES)


def bands(samples: np.ndarray) -> np.ndarray:
    """The key of each band (text, band): its samples packed, with the band's number."""
    key = np.zeros((len(samples), BANDS), np.int64)
    for k in range(BAND_SAMPLES):
        key = key * 17 + samples[:, _BAND[:, k]]
    return key * BANDS + np.arange(BANDS)


FOUND = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_bands long"


def _results(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    """Rows of (doc_id, text, next text)."""
    texts = [t for _, t, _ in rows]
    edited = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for _, t, after in rows]
    # Each text is walked once, as itself or as another row's next.
    number: dict[str, int] = {}
    for t in (*texts, *(after for _, _, after in rows)):
        number.setdefault(t, len(number))
    made = walk([*number, *edited])
    own = made[[number[t] for t in texts]]
    after = made[[number[t] for _, _, t in rows]]
    changed = made[len(number) :]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _, _ in rows], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(shown(own), pa.string()),
            pa.array(shown(changed), pa.string()),
            pa.array(likeness(own, changed)),
            pa.array(likeness(own, after)),
            pa.array((bands(own) == bands(changed)).sum(axis=1), pa.int64()),
        ],
        names=[f.split()[0] for f in FOUND.split(", ")],
    )


def _in_order(batches):
    """Pairs of neighbours in sorted rows; a range ends with a row that only serves as the next."""
    held, size, last = [], 0, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("ghost", "doc_id", "text"))
        for ghost, doc_id, text in zip(*columns, strict=True):
            if last is not None:
                held.append((*last, text))
                size += len(text) + 1
                if size >= CHUNK:
                    yield _results(held)
                    held, size = [], 0
            last = None if ghost else (doc_id, text)
    if held:
        yield _results(held)


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are."""
    rows = id_text(docs)
    # The cuts are literals of the plan, so their number is bounded; ranges are streams and may grow.
    most = max(MOST_RANGES, 8 * docs.sparkSession.sparkContext.defaultParallelism)
    ranges = max(1, min(-(-rows.count() // RANGE_ROWS), most))
    cuts = rows.agg(
        F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)] or [0.5], 10 * ranges + 100).alias("cuts")
    ).first()["cuts"] or []
    # Range 0 has the largest ids; null ids are in a range of their own at the end.
    cuts = sorted(set(cuts), reverse=True) if ranges > 1 else []
    dealt = _range_of(rows, cuts)
    firsts = dealt.groupBy("part").agg(F.max("doc_id").alias("first")).orderBy("part").collect()
    following = [(firsts[(k + 1) % len(firsts)]["first"], r["part"]) for k, r in enumerate(firsts)]
    # One row a range: bounded by the number of ranges, not by the data of a range.
    ghosts = docs.sparkSession.createDataFrame(following, "first long, part int")
    after = rows.join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "text", "part")
    every = dealt.withColumn("ghost", F.lit(False)).unionByName(after.withColumn("ghost", F.lit(True)))
    return (
        every.repartition(ranges, "part")
        .sortWithinPartitions("part", "ghost", F.col("doc_id").desc_nulls_last(), "text")
        .select("ghost", "doc_id", "text")
        .mapInArrow(_in_order, FOUND)
    )


def _range_of(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """Adds `part`: in descending order of doc_id, the cuts before it; null ids come last."""
    rising = sorted(int(c) for c in cuts)
    below = F.lit(0)
    if rising:
        # Two short searches, among every 64th cut and then in between.
        doc_id = F.col("doc_id")
        blocks = [rising[k : k + 64] for k in range(0, len(rising), 64)]
        coarse = F.size(F.filter(F.array(*[F.lit(b[0]).cast("long") for b in blocks]), lambda c: c < doc_id))
        fine = F.array(*[F.array(*[F.lit(c).cast("long") for c in b]) for b in blocks])
        inner = F.size(F.filter(F.element_at(fine, F.greatest(coarse, F.lit(1))), lambda c: c < doc_id))
        below = F.greatest(coarse - 1, F.lit(0)) * 64 + inner
    part = F.when(F.col("doc_id").isNull(), len(rising) + 1).otherwise(F.lit(len(rising)) - below)
    return rows.withColumn("part", part.cast("int"))


def similar(queries: DataFrame, found: DataFrame, like: float = LIKE) -> DataFrame:
    """Documents of found (doc_id, fingerprint) like the queries: query_id, doc_id, likeness.

    Fingerprints are made distinct first, so a text that is copied often is compared once. A pair
    that shares a band is verified; ids come back by a join.
    """

    def keyed(batches):
        for batch in batches:
            names = batch.column("fingerprint").to_pylist()
            keys = bands(read(names))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(names, object), BANDS), pa.string()), pa.array(keys.ravel())], names=["fingerprint", "key"]
            )

    def verified(batches):
        for batch in batches:
            a, b = (read(batch.column(c).to_pylist()) for c in ("query", "fingerprint"))
            near = likeness(a, b)
            kept = pa.array(np.flatnonzero(near >= like))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query").take(kept), batch.column("fingerprint").take(kept), pa.array(near).take(kept)],
                names=["query", "fingerprint", "likeness"],
            )

    def keys(rows):
        return rows.select("fingerprint").distinct().mapInArrow(keyed, "fingerprint string, key long")

    pairs = keys(queries).withColumnRenamed("fingerprint", "query").join(keys(found), "key").select("query", "fingerprint").distinct()
    near = pairs.mapInArrow(verified, "query string, fingerprint string, likeness double")
    asked = queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("query"))
    return (
        near.join(asked, "query").join(found.select("doc_id", "fingerprint"), "fingerprint").select("query_id", "doc_id", "likeness")
    )
