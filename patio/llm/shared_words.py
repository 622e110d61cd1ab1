"""Passages of more than 50 words that stand in another document, too.

suffix_dedup judges stretches of 400 bytes; a passage of 51 words is often shorter. Here the
places of a text are counted at which WORDS words begin that stand in another text as well.
Words are what lies between white space, so lines may be broken in another way there.

1. The anchors of suffix_anchors, over words instead of bytes. Anchors whose key stands in one
   text only cannot begin a shared passage; a bitmap tells most of them.
2. Anchors whose whole surroundings are equal in two texts: all their passages are shared.
3. Where surroundings of one key differ, their passages are rows, counted by hash and combined
   before the shuffle.

Words and passages are known by 64-bit hashes. Copies of a text are not seen here; their caller
knows them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.common import in_pieces, marked, stored_table, utf8
from patio.llm.suffix_anchors import Hasher, anchors
from patio.llm.words import spans, word_bounds

#: Words of a passage.
WORDS = 51
#: Bytes of a text that has so many, at least.
LEAST = 2 * WORDS - 1
#: An anchor is one of the first so many places of a passage, chosen by so many words.
WINDOW = 40
GRAM = 2
#: Bytes of text that are hashed together.
BATCH_BYTES = 1 << 20


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each row (one more than rows)."""
    data, at = utf8(texts)
    start, end, first = word_bounds(data, at)
    return Hasher(data, 0)(start, end), first


def _anchored(batches):
    for batch in in_pieces(batches, BATCH_BYTES):
        found = anchors(*_words(batch.column("text")), WORDS, WINDOW, GRAM)
        size = (found["hi"] - found["lo"] + 1).astype(np.int32)
        arrays = [batch.column("s").take(pa.array(found["row"])), *map(pa.array, (found["kr"], found["f"], found["lo"].astype(np.int32), size))]
        yield pa.RecordBatch.from_arrays(arrays, names=["s", "kr", "f", "lo", "size"])


def _passages(batches):
    """One row for each passage of asked anchors."""
    for batch in in_pieces(batches, BATCH_BYTES):
        words, first = _words(batch.column("text"))
        asked = batch.column("asked")
        edge = asked.offsets.to_numpy().astype(np.int64)
        x = {n: asked.values.field(n).to_numpy()[edge[0] : edge[-1]] for n in ("lo", "size", "high", "n")}
        start = spans(np.repeat(first[:-1], np.diff(edge)) + x["lo"], x["size"])
        owner = np.repeat(np.arange(len(x["size"])), x["size"])
        code = Hasher(words, 1)(start, start + WORDS).view(np.int64)
        low = np.repeat(batch.column("s").to_numpy(), np.diff(edge))[owner]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (code, low, x["high"][owner], x["n"][owner])], names=["code", "low", "high", "n"])


def shared_places(rows: DataFrame) -> DataFrame:
    """s and `shared`, places that begin a passage which stands in another text, of rows (s, text)
    with one number s for each text; texts without such a place have no row. A text that comes
    twice is counted more than once."""
    rows = rows.select("s", "text")
    found = rows.mapInArrow(_anchored, "s long, kr long, f long, lo int, size int")
    ends = (F.min("s").alias("low"), F.max("s").alias("high"))
    keys = stored_table(found.groupBy("kr").agg(*ends).where("low != high").select(F.col("kr").alias("s")))
    # What the bitmap lets through besides stands in one text and is not counted below.
    near = marked(found.withColumnsRenamed({"s": "t", "kr": "s"}), keys).where("maybe").withColumnsRenamed({"s": "kr", "t": "s"})
    near = stored_table(near.drop("maybe"))
    one = F.min(F.struct("s", "lo", "size")).alias("one")
    kinds = stored_table(near.groupBy("kr", "f").agg(one, F.max("s").alias("high"), F.count(F.lit(1)).alias("n")))
    shared = kinds.where("one.s != high").select("kr", "f")
    whole = near.join(shared, ["kr", "f"], "left_semi").select("s", F.col("size").cast("long").alias("shared"))
    several = kinds.groupBy("kr").agg(F.count(F.lit(1)).alias("k"), F.min("one.s").alias("low"), F.max("high").alias("high"))
    several = stored_table(several.where("k > 1 and low != high").select(F.col("kr").alias("s")))
    # All kinds of a key pass the bitmap or none; kinds that it lets through besides share nothing more.
    asked = marked(kinds.select(F.col("kr").alias("s"), "one", "high", "n"), several).where("maybe")
    asked = stored_table(asked.groupBy("one.s").agg(F.collect_list(F.struct("one.lo", "one.size", "high", "n")).alias("asked")))
    once = marked(rows, asked.select("s")).where("maybe").select("s", "text").dropDuplicates(["s"])
    # Passages of each kind: those of one text alone have it as low and high.
    spread = stored_table(once.join(asked, "s").mapInArrow(_passages, "code long, low long, high long, n long"))
    twice = spread.groupBy("code").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low != high").select("code")
    parts = spread.where("low = high").join(stored_table(twice), "code", "left_semi").select(F.col("low").alias("s"), F.col("n").alias("shared"))
    return whole.unionByName(parts).groupBy("s").agg(F.sum("shared").alias("shared"))
