"""Language identification with a byte convolutional network.

Texts are cut into windows of WINDOW bytes. Filters of several widths slide over the bytes; the
largest activation of each filter in the window goes through a softmax layer. The filters read
one-hot bytes, so a filter is a table of weights (position, byte), and a convolution is a sum of
table rows. The network is trained in numpy on the driver, on a bounded sample of labelled rows:
at most SAMPLE documents for each language, at most SAMPLE_WINDOWS windows of each. A text's
score is the mean probability over all its windows, each counted by its bytes.

Defined cases: text that is null or has no letter gives `und` with score 0, and so does every
text when there is nothing to learn from. Rows with null lang are predicted but not learned
from. A row with null doc_id is never learned from and counts as held out. Repeated rows are
predicted each. Very long texts are read in slices of windows. No other column is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.common import id_text, in_pieces, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE = 400
SAMPLE_WINDOWS = 4
STEPS = 500
BATCH = 128
SLICE = 256
UNKNOWN = "und"
# Names beside the columns of an input, which may have any others.
LETTERS, LANG, SCORE = "__language_id_letters", "__language_id_lang", "__language_id_score"


class Network:
    """Filters by width: a table (width, 256, FILTERS) and a bias; then a dense layer."""

    def __init__(self, labels: list[str], seed: int = 7):
        random = np.random.default_rng(seed)
        self.labels = labels
        self.tables = [(random.standard_normal((w, 256, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.dense = (random.standard_normal((len(WIDTHS) * FILTERS, len(labels))) * 0.1).astype(np.float32)
        self.offset = np.zeros(len(labels), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [*self.tables, *self.bias, self.dense, self.offset]

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest activation of each filter, and where it is, by width."""
        tops, places = [], []
        for width, table, bias in zip(WIDTHS, self.tables, self.bias, strict=True):
            span = windows.shape[1] - width + 1
            out = table[0].take(windows[:, :span], axis=0)
            for k in range(1, width):
                out += table[k].take(windows[:, k : k + span], axis=0)
            place = out.argmax(axis=1)
            tops.append(np.take_along_axis(out, place[:, None, :], axis=1)[:, 0] + bias)
            places.append(place)
        return np.concatenate(tops, axis=1), places

    def peaks(self, windows: np.ndarray) -> np.ndarray:
        tops = []
        for width, table, bias in zip(WIDTHS, self.tables, self.bias, strict=True):
            span = windows.shape[1] - width + 1
            out = table[0].take(windows[:, :span], axis=0)
            for k in range(1, width):
                out += table[k].take(windows[:, k : k + span], axis=0)
            tops.append(out.max(axis=1) + bias)
        return np.concatenate(tops, axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.maximum(self.peaks(windows), 0) @ self.dense + self.offset
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        pooled, places = self.pooled(windows)
        hidden = np.maximum(pooled, 0)
        out = hidden @ self.dense + self.offset
        out = np.exp(out - out.max(axis=1, keepdims=True))
        out /= out.sum(axis=1, keepdims=True)
        out[np.arange(len(target)), target] -= 1
        out /= len(target)
        back = (out @ self.dense.T) * (pooled > 0)
        rows, filters = np.arange(len(windows))[:, None], np.arange(FILTERS)[None, :]
        tables, biases = [], []
        for i, width in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            grad = np.zeros_like(self.tables[i])
            for k in range(width):
                np.add.at(grad[k], (windows[rows, places[i] + k], filters), part)
            tables.append(grad)
            biases.append(part.sum(axis=0))
        return [*tables, *biases, hidden.T @ out, out.sum(axis=0)]


def train(windows: np.ndarray, target: np.ndarray, labels: list[str]) -> Network:
    """Adam on batches that hold every language equally often."""
    network, random = Network(labels), np.random.default_rng(11)
    by_label = [np.flatnonzero(target == k) for k in range(len(labels))]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in network.weights()]
    for step in range(1, STEPS + 1):
        own = np.concatenate([random.choice(x, -(-BATCH // len(labels))) for x in by_label])
        rate = 0.01 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for weight, (mean, square), grad in zip(
            network.weights(), moments, network.gradients(windows[own], target[own]), strict=True
        ):
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            weight -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    return network


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(True))


def fit(docs: DataFrame) -> Network | None:
    """The network over the labelled rows that are not held out; None if there are none."""
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).where(F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # A share by hash gives about SAMPLE documents of each language without a sort of texts.
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1 << 30, -(-(SAMPLE << 30) // n))).otherwise(share)
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    sample = labelled.where(rank < share).select("lang", rank.alias("rank"), "text")
    bound = SAMPLE * len(counts) * 2
    taken = sample.mapInArrow(_training_windows, "lang string, rank long, bytes binary").limit(bound).collect()
    labels = sorted({r["lang"] for r in taken})
    rows = sorted(taken, key=lambda r: (r["rank"], r["bytes"]))
    windows = [np.frombuffer(r["bytes"], np.uint8).reshape(-1, WINDOW) for r in rows]
    target = np.concatenate([np.full(len(w), labels.index(r["lang"])) for w, r in zip(windows, rows, strict=True)])
    return train(np.concatenate(windows), target, labels)


def cut(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of each row (the last one padded with zeros), their row and their bytes."""
    size = np.diff(at)
    per_row = np.maximum(1, -(-size // WINDOW))
    row = np.repeat(np.arange(len(size)), per_row)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    start = at[:-1][row] + turn * WINDOW
    length = np.clip(at[1:][row] - start, 0, WINDOW)
    place = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(place, len(data))], 0).astype(np.uint8), row, length


def _training_windows(batches):
    for batch in batches:
        data, at = utf8(batch.column("text"))
        langs, ranks, taken = batch.column("lang"), batch.column("rank").to_numpy(), []
        for i in range(batch.num_rows):
            windows, _, length = cut(data[at[i] : at[i + 1]], np.array([0, at[i + 1] - at[i]]))
            full = windows[length >= min(WINDOW, length.max())]
            pick = np.random.default_rng(int(ranks[i])).permutation(len(full))[:SAMPLE_WINDOWS]
            taken.append(full[pick].tobytes())
        yield pa.RecordBatch.from_arrays(
            [langs, batch.column("rank"), pa.array(taken, pa.binary())], names=["lang", "rank", "bytes"]
        )


def _predicted(rows: DataFrame, network: Network | None, carried: list[str]) -> DataFrame:
    """The carried columns of rows (which has `text` and LETTERS) with LANG and SCORE."""
    if network is None:
        return rows.select(*carried, F.lit(UNKNOWN).alias(LANG), F.lit(0.0).alias(SCORE))
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def predict(batches):
        model = shared.value
        for batch in in_pieces(batches, 4 << 20):
            data, at = utf8(batch.column("text"))
            total = np.zeros((batch.num_rows, len(model.labels)))
            windows, row, length = cut(data, at)
            for i in range(0, len(windows), SLICE):
                part = model.probabilities(windows[i : i + SLICE]) * length[i : i + SLICE, None]
                np.add.at(total, row[i : i + SLICE], part)
            mean = total / np.maximum(1, np.diff(at))[:, None]
            best = mean.argmax(axis=1)
            known = batch.column(LETTERS).to_numpy(zero_copy_only=False).astype(bool)
            names = np.where(known, np.array(model.labels, object)[best], UNKNOWN)
            score = np.where(known, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(names, pa.string()), pa.array(score)],
                names=[*carried, LANG, SCORE],
            )

    fields = [*rows.select(*carried).schema.fields, T.StructField(LANG, T.StringType()), T.StructField(SCORE, T.DoubleType())]
    return rows.mapInArrow(predict, T.StructType(fields))


def _lettered(docs: DataFrame) -> DataFrame:
    return docs.withColumn(LETTERS, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    rows = _lettered(id_text(docs).select("doc_id", held_out().alias("held_out"), "text"))
    return _predicted(rows, network, ["doc_id", "held_out"]).withColumnsRenamed({LANG: "lang_pred", SCORE: "score"})


def language_id(docs: DataFrame) -> DataFrame:
    """Fit on the labelled rows of docs and predict all of docs."""
    return identify(docs, fit(docs))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of docs with a language; `und` is rejected. Columns as in docs."""
    names = docs.columns
    return _predicted(_lettered(docs), fit(docs), names).where(F.col(LANG) != UNKNOWN).select(*names)
