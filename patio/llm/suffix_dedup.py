"""Repeated passages by a suffix array.

Every byte that lies in a stretch of LONG bytes which also starts anywhere else, in another
document or in the same one, is removed.

1. Texts give anchors (suffix_anchors): a stretch and its repeats have their anchor at the same
   place, with the same key. Anchors whose key stands at one place only cannot begin a repeat and
   cut the text; the phrases between the cuts are the letters of strings.
2. suffix_array sorts the suffixes of the strings with the difference-cover algorithm and
   compares neighbours. What neighbours share over LONG bytes and more is repeated.
3. Repeats end inside phrases, so the rest is decided on bytes. Anchors whose whole surroundings
   (all bytes of all their stretches) are equal are repeats of each other. Where surroundings of
   one key differ, the stretches of one document for each kind of surroundings are compared.

Equal texts are one text in all steps; a text of LONG bytes or more that occurs twice is removed
whole. Texts are known by a 64-bit hash in steps 1 to 3; hashes that two texts share, as their
SHA-256 digests tell, are replaced. Texts are shuffled only where something may be removed: a
bitmap of BITS bits, whatever the size of the data, tells most others.

A key with more than CROWDED kinds of surroundings does not meet in one task: its stretches are
counted as rows of their own, combined before the shuffle.

`n_shared` is a further count and removes nothing: places of the text at which 51 words begin that
stand in another document, too (shared_words). Such passages are mostly shorter than LONG bytes.

Defined cases: null text counts as empty; texts shorter than LONG are kept. Repeated rows count
as different documents with equal texts. Null ids are carried. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.llm.common import BITS, columns_of, id_text, in_pieces, marked, stored, stored_table, utf8
from patio.llm.shared_words import LEAST, WORDS, shared_places
from patio.llm.suffix_anchors import LONG, Hasher, anchors, mixed
from patio.llm.suffix_array import sort_suffixes
from patio.llm.words import spans as ranges

#: Bytes of text that are hashed together.
BATCH_BYTES = 1 << 20
#: Kinds of surroundings of one key that one task compares, at most.
CROWDED = 4096

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long"


def _anchored(batches):
    for batch in in_pieces(batches, BATCH_BYTES):
        found = anchors(*utf8(batch.column("text")))
        row = pa.array(found.pop("row"))
        kinds = dict.fromkeys(("i", "p", "cover", "lo", "hi"), np.int32)
        arrays = [pa.array(v.astype(kinds.get(k, np.int64))) for k, v in found.items()]
        yield pa.RecordBatch.from_arrays([batch.column("s").take(row), *arrays], names=["s", *found])


def anchor_rows(texts: DataFrame) -> DataFrame:
    """Anchors of texts (s, text)."""
    return texts.mapInArrow(_anchored, "s long, i int, p int, cover int, lo int, hi int, a long, kr long, f long")


def _codes(batches):
    """For asked anchors of each text: their columns, and size and hashes of all their stretches."""
    for batch in in_pieces(batches, BATCH_BYTES):
        data, at = utf8(batch.column("text"))
        asked = batch.column("asked")
        edge = asked.offsets.to_numpy().astype(np.int64)
        x = {n: asked.values.field(n).to_numpy()[edge[0] : edge[-1]] for n in ("kr", "f", "p", "lo", "hi", "n")}
        base = np.repeat(at[:-1], np.diff(edge))
        size = (x["hi"] - x["lo"] + 1).astype(np.int64)
        start = ranges(base + x["lo"], size)
        yield x, size, Hasher(data, 1)(start, start + LONG)


def _meeting(kr: np.ndarray, distance: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A stretch meets its repeats under one key and at one distance from the anchor."""
    return mixed(code ^ mixed(kr.view(np.uint64) + distance.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _windows(batches):
    """One row for each asked anchor, with the hashes end to end."""
    for x, size, code in _codes(batches):
        ends = np.concatenate(([0], np.cumsum(size))) * 8
        blob = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(code.tobytes())]
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(x["kr"]), pa.array(x["f"]), pa.array((x["p"] - x["lo"]).astype(np.int32)), blob.cast(pa.binary())], names=["kr", "f", "first", "codes"]
        )


def _stretches(batches):
    """One row for each stretch of asked anchors."""
    for x, size, code in _codes(batches):
        offset = ranges(np.zeros(len(size), np.int64), size)
        owner = np.repeat(np.arange(len(size)), size)
        kr = x["kr"][owner]
        key = _meeting(kr, (x["p"] - x["lo"])[owner] - offset, code).view(np.int64)
        arrays = (kr, x["f"][owner], offset.astype(np.int32), key, x["n"][owner] > 1)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in arrays], names=["kr", "f", "x", "key", "whole"])


def _repeated(batches):
    """Stretches that stand in two kinds of surroundings, or twice in one: runs (x to y) for each."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    kr, f, first = (table.column(n).to_numpy() for n in ("kr", "f", "first"))
    # Copies of a text bring the same rows again.
    _, once = np.unique(np.stack((kr, f), 1), axis=0, return_index=True)
    blobs = [b.as_py() for b in table.column("codes").take(pa.array(once))]
    size = np.array([len(b) // 8 for b in blobs], np.int64)
    code = np.frombuffer(b"".join(blobs), np.uint64)
    offset = ranges(np.zeros(len(size), np.int64), size)
    owner = np.repeat(np.arange(len(size)), size)
    key = _meeting(kr[once][owner], first[once][owner] - offset, code)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    if not len(at):
        return
    new = np.flatnonzero(np.concatenate(([True], (np.diff(at) > 1) | (owner[at][1:] != owner[at][:-1]))))
    last = np.append(new[1:], len(at)) - 1
    own = once[owner[at[new]]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(kr[own]), pa.array(f[own]), pa.array(offset[at[new]].astype(np.int32)), pa.array(offset[at[last]].astype(np.int32))],
        names=["kr", "f", "x", "y"],
    )


def _joined(batches):
    """Union of the intervals (x to y) of each text."""
    v = columns_of(batches)
    if not v:
        return
    order = np.lexsort((v["y"], v["x"], v["s"]))
    s, x, y = v["s"][order], v["x"][order].astype(np.int64), v["y"][order].astype(np.int64)
    head = np.concatenate(([True], s[1:] != s[:-1]))
    group = np.cumsum(head) - 1
    # Reach so far within a text: texts are set apart by an offset larger than any text.
    apart = group * (int(y.max()) + 2)
    reach = np.maximum.accumulate(y + apart)
    new = np.concatenate(([True], x[1:] + apart[1:] > reach[:-1]))
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(s)) - 1
    end = reach[stop] - apart[stop]
    texts = np.flatnonzero(np.concatenate(([True], s[start][1:] != s[start][:-1])))
    edge = pa.array(np.append(texts, len(start)).astype(np.int32))
    yield pa.RecordBatch.from_arrays(
        [pa.array(s[start][texts]), pa.ListArray.from_arrays(edge, pa.array(x[start])), pa.ListArray.from_arrays(edge, pa.array(end))],
        names=["s", "starts", "ends"],
    )


def _removed(batches):
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("doc_id", "text", "starts", "ends", "shared", "copied"))
        out = []
        for doc_id, text, starts, ends, shared, copied in zip(*columns, strict=True):
            raw, at, kept = text.encode(), 0, hashlib.sha256()
            for x, y in zip(starts or (), ends or (), strict=True):
                kept.update(raw[at:x])
                at = y
            kept.update(raw[at:])
            gone = sum(ends or ()) - sum(starts or ())
            places = max(0, len(raw.split()) - WORDS + 1) if copied else shared or 0
            out.append((doc_id, len(raw), gone, len(starts or ()), kept.hexdigest(), places))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()]
        arrays = [pa.array(list(c), t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 6, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared"])


def _name(text: Column, turn: int) -> Column:
    return F.xxhash64(text, F.lit(turn)) if turn else F.xxhash64(text)


def named_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text, n, s), where s is one number for each text of LEAST bytes or more, and
    the distinct texts of that length (s, n, k rows)."""
    rows = id_text(docs).withColumn("n", F.octet_length("text")).withColumn("s", _name(F.col("text"), 0))
    for turn in count(1):
        digest = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))
        long = rows.where(F.col("n") >= LEAST).select("s", "n", digest.alias("d"))
        texts = stored_table(long.groupBy("d").agg(F.count(F.lit(1)).alias("k"), F.min("s").alias("s"), F.min("n").alias("n")).drop("d"))
        clashes = stored(texts.groupBy("s").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("s"))
        if clashes.isEmpty():
            return rows, texts
        rows = marked(rows, clashes).withColumn("s", F.when(F.col("maybe"), _name(F.col("text"), turn)).otherwise(F.col("s"))).drop("maybe")


def _runs(long: DataFrame, kinds: DataFrame) -> DataFrame:
    """Stretches (kr, f, x to y) that stand in several kinds of surroundings of one key."""
    several = stored_table(
        kinds.groupBy("kr").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("kr", (F.col("k") > CROWDED).alias("crowded"))
    )

    def texts(keys: DataFrame) -> DataFrame:
        each = F.struct("kr", "f", "one.p", "one.lo", "one.hi", "n")
        asked = kinds.join(keys.select("kr"), "kr", "left_semi").groupBy("one.s").agg(F.collect_list(each).alias("asked"))
        once = marked(long.select("s", "text"), asked.select("s")).where("maybe").dropDuplicates(["s"])
        return once.join(asked, "s").select("text", "asked")

    few = texts(several.where("not crowded")).mapInArrow(_windows, "kr long, f long, first int, codes binary")
    runs = few.repartition("kr").mapInArrow(_repeated, "kr long, f long, x int, y int")
    crowded = several.where("crowded")
    if crowded.isEmpty():
        return runs
    spread = stored_table(texts(crowded).mapInArrow(_stretches, "kr long, f long, x int, key long, whole boolean"))
    low, high = F.min("f").alias("low"), F.max("f").alias("high")
    twice = stored_table(spread.groupBy("kr", "key").agg(low, high).where("low != high").select("kr", "key"))
    found = spread.where("not whole").join(twice, ["kr", "key"], "left_semi")
    return runs.unionByName(found.select("kr", "f", "x", F.col("x").alias("y")))


def repeated_spans(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Byte intervals to remove, by text: s, starts, ends (apart from each other, in order); of
    the two results of named_texts."""
    long = rows.where(F.col("n") >= LONG)
    found = anchor_rows(long.select("s", "text"))
    place = F.xxhash64("s", "i")
    # Stored, so that Spark may split the rows of one key in the join.
    shared = stored_table(
        found.groupBy("kr").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high").select("kr")
    )
    strings = found.join(shared, "kr", "left_semi").select("s", F.lit(0).alias("r"), "i", "a", "p", "cover", "lo", "hi", "kr", "f")
    # Copies of a text bring the same rows; they are combined before the rows of a text meet in one task.
    strings = stored_table(strings.dropDuplicates(["s", "i"]))
    near = sort_suffixes(strings)
    kinds = stored_table(
        near.groupBy("kr", "f").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("s", "p", "lo", "hi")).alias("one"))
    )
    # A kind of surroundings that occurs twice is repeated whole; else its runs are.
    whole = kinds.where("n > 1").select("kr", "f", F.lit(0).alias("x"), F.lit(None).cast("int").alias("y"))
    marks = _runs(long, kinds).unionByName(whole)
    inside = near.join(marks, ["kr", "f"]).select(
        "s", (F.col("lo") + F.col("x")).alias("x"), (F.coalesce(F.col("lo") + F.col("y"), F.col("hi")) + LONG).alias("y")
    )
    # What neighbours in the suffix array share over LONG bytes and more.
    sure = near.where(F.col("shared") >= LONG).select("s", F.col("p").alias("x"), (F.col("p") + F.col("shared")).alias("y"))
    copied = texts.where((F.col("k") > 1) & (F.col("n") >= LONG)).select("s", F.lit(0).alias("x"), F.col("n").cast("int").alias("y"))
    every = inside.unionByName(sure).unionByName(copied)
    return stored(every.repartition("s").mapInArrow(_joined, "s long, starts array<long>, ends array<long>"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared of every row."""
    named, texts = named_texts(docs)
    spans = repeated_spans(named, texts)
    shared = shared_places(named.where(F.col("n") >= LEAST))
    copied = texts.where("k > 1").select("s", F.lit(True).alias("copied"))
    found = stored(spans.join(shared, "s", "full").join(copied, "s", "full"))
    # A short text may have the number of a long one.
    rows = marked(named, found.select("s")).withColumn("maybe", F.col("maybe") & (F.col("n") >= LEAST))
    touched = rows.where("maybe").select("doc_id", "text", "s").join(found, "s", "left")
    changed = touched.select("doc_id", "text", "starts", "ends", "shared", "copied").mapInArrow(_removed, RESULT)
    zero = F.lit(0).cast("long")
    same = rows.where("not maybe").select(
        "doc_id", F.col("n").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"), zero.alias("n_shared"),
    )
    return changed.unionByName(same)
