"""Exact dedup over a minimal perfect hash of historical digests.

The distinct digests of a history are dealt into buckets of bounded size. In each bucket a
minimal perfect hash (hash and displace) gives every digest a slot of its own; the slots hold
the full digests, the winner (smallest doc_id) and its count. Incoming digests are counted
first, so that a text that makes up a third of the rows is one row here; a lookup computes the
slot and compares all 32 bytes. Members are repeats of the slot's winner. Digests that are not
in the history form groups among themselves.

Defined cases: null text counts as empty, and all empty texts are one group. A null doc_id sorts
after all others and is never the row that stays unless its whole group has none. Rows repeated
with one doc_id and one text each get a row; `copy` numbers them, and only copy 1 can be kept.
Other columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.common import SPACES, id_text, stored

#: Distinct digests in a bucket, on average.
BUCKET_KEYS = 2000
#: Digests that share one displacement, on average.
DISPLACED_TOGETHER = 4

INDEX = "bucket int, displacements array<int>, digests binary, winners array<long>, counts array<long>"
RESOLVED = "digest binary, winner long, seen long"
NO_ID = np.iinfo(np.int64).max


def normalised(text):
    return F.regexp_replace(text, SPACES, " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the normalised text, 32 bytes."""
    return id_text(docs).select(
        "doc_id", F.unhex(F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)).alias("digest")
    )


def _words(keys: np.ndarray) -> np.ndarray:
    return keys.view("<u8").reshape(len(keys), 4)


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    return (_words(keys)[:, 1] % np.uint64(groups)).astype(np.int64)


def _slot(keys: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Slots of keys in a bucket of n; every displacement hashes two words of the digest anew."""
    words = _words(keys)
    x = words[:, 2] + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30)) ^ words[:, 3]) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(n)).astype(np.int64)


def build_bucket(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacement of each group and slot of each key; keys are distinct rows of 32 bytes.

    Large groups are placed first. A group takes the first displacement that puts all its keys
    into free slots of their own; the last key of n needs about n tries.
    """
    n = len(keys)
    groups = -(-n // DISPLACED_TOGETHER)
    group = _group(keys, groups)
    order = np.argsort(group, kind="stable")
    members = np.split(order, np.cumsum(np.bincount(group, minlength=groups))[:-1])
    taken = np.zeros(n, bool)
    slots = np.zeros(n, np.int64)
    displacements = np.zeros(groups, np.int64)
    for g in sorted(range(groups), key=lambda g: -len(members[g])):
        own, first, width = members[g], 0, 32
        while len(own):
            tries = np.arange(first, first + width)
            at = _slot(np.tile(keys[own], (width, 1)), np.repeat(tries, len(own)), n).reshape(width, len(own))
            free = ~taken[at].any(axis=1)
            if len(own) > 1:
                ranked = np.sort(at, axis=1)
                free &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if free.any():
                pick = int(np.argmax(free))
                displacements[g], slots[own] = tries[pick], at[pick]
                taken[at[pick]] = True
                break
            first, width = first + width, min(4 * width, 4096)
    return displacements, slots


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, 32)


def _build(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("digest")
    keys = _matrix(part["digest"])
    displacements, slots = build_bucket(keys)
    back = np.argsort(slots)
    return pd.DataFrame(
        {
            "bucket": [int(part["bucket"].iloc[0])],
            "displacements": [displacements],
            "digests": [keys[back].tobytes()],
            "winners": [part["winner"].to_numpy()[back]],
            "counts": [part["seen"].to_numpy()[back]],
        }
    )


def _probe(incoming: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """The history's winner and count of each incoming digest, or the incoming ones."""
    out = incoming[["digest", "winner", "seen"]].copy()
    if len(index) and len(incoming):
        row = index.iloc[0]
        slots = _matrix([row["digests"]])
        keys = _matrix(incoming["digest"])
        displacements = np.asarray(row["displacements"])
        at = _slot(keys, displacements[_group(keys, len(displacements))], len(slots))
        member = (slots[at] == keys).all(axis=1)
        out["winner"] = np.where(member, np.asarray(row["winners"])[at], out["winner"])
        out["seen"] = out["seen"] + np.where(member, np.asarray(row["counts"])[at], 0)
    return out


def _buckets(distinct: DataFrame, n: int) -> DataFrame:
    """The bucket comes from the first four bytes of the digest, which the slots do not use."""
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return distinct.withColumn("bucket", F.pmod(first, F.lit(n)).cast("int"))


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.coalesce(F.min("doc_id"), F.lit(int(NO_ID))).alias("winner"), F.count(F.lit(1)).alias("seen")
    )


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """One row for each bucket of the distinct digests of the history (doc_id, digest)."""
    return _buckets(_counted(history), n_buckets).groupBy("bucket").applyInPandas(_build, INDEX)


def resolve(incoming: DataFrame, index: DataFrame, n_buckets: int) -> DataFrame:
    """Winner and group size of each distinct digest of incoming rows (doc_id, digest)."""
    counted = _buckets(_counted(incoming), n_buckets)
    return counted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_probe, RESOLVED)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, copy, keep_id, group_size, kept, text_sha256 of every row.

    The half of the table with the smaller ids is the history; its distinct digests are indexed
    and the other half is looked up. The smallest doc_id of equal texts stays.
    """
    rows = stored(digests(docs))
    n_rows, low, high = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    n_buckets = max(1, -(-n_rows // BUCKET_KEYS))
    middle = (low + high) // 2 if low is not None else 0
    older = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    index = stored(build_index(rows.where(older), n_buckets))
    newer = resolve(rows.where(~older), index, n_buckets)
    slots = index.select(
        F.posexplode("winners").alias("slot", "winner"), "digests", "counts"
    ).select(
        F.expr("substring(digests, slot * 32 + 1, 32)").alias("digest"),
        "winner",
        F.expr("counts[slot]").alias("seen"),
    )
    # Stored, so that both sides of the join below are exchanges that Spark can split when skewed.
    found = stored(
        newer.unionByName(slots)
        .groupBy("digest")
        .agg(F.min("winner").alias("winner"), F.max("seen").alias("group_size"))
        .select(F.col("digest"), F.expr(f"nullif(winner, {NO_ID})").alias("keep_id"), "group_size")
    )
    same = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    return (
        same.join(found, "digest")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select(
            "doc_id",
            "keep_id",
            F.col("group_size").cast("long").alias("group_size"),
            ((F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            F.col("copy").cast("long").alias("copy"),
        )
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_dedup keeps, with the columns of docs.

    Of rows repeated with one doc_id and one text, any one stays.
    """
    ids = (
        exact_dedup(docs)
        .groupBy("doc_id", "text_sha256")
        .agg(F.max("kept").alias("stays"), F.max("copy").alias("copies"))
        .where("stays")
        .select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), "copies")
    )
    # Rows travel as one column, so that no name of theirs can clash.
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.encode(normalised(text), "UTF-8"), 256).alias("key")
    )
    joined = keyed.join(ids, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("sha")))
    repeated = joined.where("copies > 1").dropDuplicates(["id", "key"])
    return joined.where("copies = 1").select("row.*").unionByName(repeated.select("row.*"))
