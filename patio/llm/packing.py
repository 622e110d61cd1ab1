"""Best-fit packing by the sum-of-squares rule.

Documents become token ids; those of more than CAPACITY ids are cut into full pieces and a
rest. Full pieces are sequences by themselves. Every other piece goes, longest first, to the
open sequence (or a new one) after which the sum over all gaps of the squared number of open
sequences with that gap is smallest. Ties go to the smaller gap that is left, so that sequences
close early.

Pieces are dealt to groups of about GROUP_PIECES by hash; each group is packed by itself.
What a group leaves in open sequences is dealt again with the open sequences of other groups,
as one block of that length, until one group is left or a round joins fewer than one block in
LEAST_GAIN. The number of groups follows what is left, so that no group grows with the table.

Defined cases: null text counts as empty; an empty document is the closing id 0 alone. Equal
lengths are placed by doc_id, then piece. Repeated rows are packed each. A null doc_id is
packed like any other. An empty table gives an empty result. Very long texts become pieces in
one pass. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.bpe import Encoder
from patio.llm.common import id_text, in_pieces, stored, utf8

CAPACITY = 2048
CLOSING = 0
GROUP_PIECES = 50_000
LEAST_GAIN = 100
#: Bytes of text that are encoded together.
BATCH_BYTES = 1 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of every document, with the CRC of their ids."""
    rows = id_text(docs)

    def run(batches):
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encoder = _encoders[tokenizer]
        for batch in in_pieces(batches, BATCH_BYTES):
            ids, at = encoder.ids(*utf8(batch.column("text")), CLOSING)
            total = np.diff(at)
            count = -(-total // CAPACITY)
            row = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * CAPACITY
            length = np.minimum(CAPACITY, total[row] - start)
            view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            first = (at[:-1][row] + start) * 4
            crc = [zlib.crc32(view[a:b]) for a, b in zip(first.tolist(), (first + length * 4).tolist(), strict=True)]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(run, PIECES)


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each item, by the sum-of-squares rule in the order given.

    Only gaps matter, so open bins are stacks by gap. Putting an item into a bin of gap g makes
    the sum of squares change by 2 (N[g - s] - N[g]) + 2, or for a new bin by 2 N[c - s] + 1; a
    bin that fills up leaves the sum and only takes away its old gap's share.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    number = np.zeros(capacity + 1, np.int64)
    out = np.empty(len(lengths), np.int64)
    made = 0
    for k, s in enumerate(lengths.tolist()):
        change = 2 * (number[: capacity - s + 1] - number[s:]) + 2
        change[0] = 1 - 2 * number[s]
        change[number[s:] == 0] = np.iinfo(np.int64).max
        left = int(change.argmin())
        fresh = 2 * number[capacity - s] + 1 if s < capacity else 0
        if change[left] <= fresh:
            own = open_bins[left + s].pop()
            number[left + s] -= 1
        else:
            own, left = made, capacity - s
            made += 1
        out[k] = own
        if left:
            open_bins[left].append(own)
            number[left] += 1
    return out


def _packed(part: pd.DataFrame) -> pd.DataFrame:
    """Bins of one group's blocks: block, bin, place in the bin, and how full the bin is."""
    part = part.sort_values(["length", "block"], ascending=[False, True], kind="stable")
    length = part["length"].to_numpy()
    own = place(length)
    full = np.bincount(own, length).astype(np.int64)
    order = np.argsort(own, kind="stable")
    ahead = np.cumsum(length[order]) - length[order]
    heads = np.searchsorted(own[order], np.arange(len(full)))
    offset = np.empty(len(own), np.int64)
    offset[order] = ahead - np.repeat(ahead[heads], np.bincount(own)) if len(own) else ahead
    group = int(part["group"].iloc[0])
    return pd.DataFrame(
        {
            "block": part["block"].to_numpy(),
            "bin": (group << 32) + own,
            "at": offset,
            "filled": full[own],
        }
    )


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    made = pieces(docs, tokenizer or default_tokenizer())
    # Rows that agree in all fields are interchangeable, so their numbers may fall either way.
    made = stored(made.withColumn("id", F.monotonically_increasing_id()))
    short = made.where(F.col("length") < CAPACITY)
    blocks = short.select(F.col("id").alias("block"), "length")
    held = short.select("id", F.col("id").alias("block"), F.lit(0).cast("long").alias("at"))
    left = blocks.count()
    groups = max(1, -(-left // GROUP_PIECES))
    turn = 0
    while True:
        dealt = blocks.withColumn("group", F.pmod(F.xxhash64("block", F.lit(turn)), F.lit(groups)))
        bins = stored(dealt.groupBy("group").applyInPandas(_packed, "block long, bin long, at long, filled long"))
        # A bin takes the number of its first block, so numbers of earlier rounds stay apart.
        lead = bins.groupBy("bin").agg(F.min("block").alias("lead"), F.max("filled").alias("length"))
        moved = bins.select("block", "bin", F.col("at").alias("more")).join(lead, "bin")
        held = stored(
            held.join(moved, "block", "left").select(
                "id", F.coalesce("lead", "block").alias("block"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at")
            )
        )
        if groups == 1:
            break
        lead = stored(lead)
        joined = left - lead.count()
        blocks = lead.where(F.col("length") < CAPACITY).select(F.col("lead").alias("block"), "length")
        gained, left = joined * LEAST_GAIN >= left, blocks.count()
        if not left or not gained:
            break
        turn += 1
        groups = max(1, -(-left // GROUP_PIECES))
    full = made.where(F.col("length") == CAPACITY).withColumns({"sequence_id": F.col("id"), "offset": F.lit(0).cast("long")})
    placed = held.select("id", F.col("block").alias("sequence_id"), F.col("at").alias("offset"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(*names).unionByName(short.join(placed, "id").select(*names))
