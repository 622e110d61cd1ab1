"""Helpers that the text operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: blank and the five control characters after it.
SPACES = r"[\x20\x09-\x0D]+"
#: Size of the bitmap of marked texts.
BITS = 1 << 26


def shipped(spark: SparkSession) -> None:
    """Send the package to the workers where they would not find it by themselves."""
    root = Path(__file__).resolve().parents[2]
    seen = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    if root in [p.resolve() for p in seen] or spark.sparkContext.applicationId in _sent:
        return
    name = Path(tempfile.mkdtemp(prefix="patio-code-")) / "patio"
    spark.sparkContext.addPyFile(shutil.make_archive(str(name), "zip", root, "patio"))
    _sent.add(spark.sparkContext.applicationId)


_sent: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns that operators read, whatever else the input carries; null text is empty."""
    shipped(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _shared_folder(df: DataFrame) -> str:
    """The checkpoint folder of the session, from spark.checkpoint.dir.

    Where the session names none (a local session, tests) a temporary one is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="patio-llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """Write a frame that several later steps read to the shared folder, and read it from there."""
    _shared_folder(df)
    return df.checkpoint(eager=True)


def stored_table(df: DataFrame) -> DataFrame:
    """As stored, as a parquet table, for frames of many narrow rows.

    The table lies in the checkpoint folder of the session and goes with it.
    """
    path = f"{_shared_folder(df)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns_of(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    """All rows of a partition as arrays by column; empty if there are none. Nulls must not occur."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    return {n: table.column(n).to_numpy() for n in table.column_names} if table is not None and table.num_rows else {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end and the offsets of its rows (one more than rows)."""
    column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def in_pieces(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one piece holds about max_bytes of text, or a single row."""
    for batch in batches:
        _, at = utf8(batch.column("text"))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(at, at[first] + max_bytes, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def marked(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds `maybe`: false where the text (s) is surely not among texts.

    A bitmap by s is broadcast, of at most BITS / 64 words whatever the size of the data.
    """

    def bit():
        return F.expr(f"shiftleft(1L, cast(pmod(s, {BITS}) % 64 as int))")

    word = F.shiftright(F.pmod(F.col("s"), F.lit(BITS)), 6)
    bitmap = texts.select(word.alias("_word"), bit().alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    held = rows.join(F.broadcast(bitmap), word == F.col("_word"), "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(bit()) != 0, F.lit(False))
    return held.select(*rows.columns, maybe.alias("maybe"))
