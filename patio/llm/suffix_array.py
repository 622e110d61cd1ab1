"""A distributed difference-cover suffix array over a collection of strings.

Strings are rows (s, r, i, a): string, part of a recursion, place, letter; a place that is
missing ends a string. As in the difference cover modulo three:

1. The triples of letters at places 1 and 2 modulo 3 are sorted; a triple's name is its place
   among the distinct ones.
2. Where names repeat and do not yet reach REACH bytes, the names are strings of a third of the
   length (places 1 and 2 apart), and their suffixes are sorted by recursion.
3. The suffixes at places 0 modulo 3 are ordered by (letter, rank of the next place) and merged:
   among those at 1 by (letter, rank), among those at 2 by (letter, letter, rank). The merge is
   dealt by sampled suffixes of all places; equal ones are dealt by string and place, so parts are
   even, whatever repeats and wherever it stands. About 3 * TOP_PARTS * SAMPLED samples reach the
   driver at most; where more parts are needed, a task cuts each of these once more by the
   samples in it.

Ranks order all suffixes up to REACH bytes; equal ones stand together in any order. The merge
compares each suffix with its neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.common import columns_of, stored, stored_table

#: Suffixes are told apart over so many bytes.
REACH = 400
#: Sampled suffixes for each part of a merge.
SAMPLED = 32
#: Suffixes in one part of a merge, about, at most.
PART_ROWS = 60_000
#: Parts that the driver's sample cuts, at most.
TOP_PARTS = 2048
#: Parts of one of these, below.
SUB_BITS = 18
#: Tasks of a merge, at most; a task takes one part after another.
MERGE_TASKS = 16_384

#: String, recursion part, place, letter, byte place, bytes of the letter; the rest is carried.
STRING = ("s", "r", "i", "a", "p", "cover", "lo", "hi", "kr", "f")
_LONG = "s long, r int, i int, a long, p int, cover int, lo int, hi int, kr long, f long"


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _sorted(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """By string and place, each place once."""
    order = np.lexsort((x["i"], x["r"], x["s"]))
    x = {k: v[order] for k, v in x.items()}
    new = np.ones(len(x["s"]), bool)
    new[1:] = (x["s"][1:] != x["s"][:-1]) | (x["r"][1:] != x["r"][:-1]) | (x["i"][1:] != x["i"][:-1])
    return {k: v[new] for k, v in x.items()}


def _ahead(x: dict[str, np.ndarray], k: int) -> np.ndarray:
    """For sorted rows, the row k places on in the same string, or -1."""
    n = len(x["s"])
    at = np.minimum(np.arange(n) + k, n - 1)
    same = (x["s"][at] == x["s"]) & (x["r"][at] == x["r"]) & (x["i"][at] == x["i"] + k)
    return np.where(same, at, -1)


def _taken(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at >= 0, values[np.maximum(at, 0)], 0)


def _triples(batches):
    x = columns_of(batches)
    if x:
        x = _sorted(x)
        one, two = _ahead(x, 1), _ahead(x, 2)
        end = np.where(two >= 0, two, np.where(one >= 0, one, np.arange(len(one))))
        cover = x["p"][end] - x["p"] + x["cover"][end]
        sample = x["i"] % 3 != 0
        out = {"s": x["s"], "r": x["r"], "i": x["i"], "a": x["a"], "b": _taken(x["a"], one), "c": _taken(x["a"], two)}
        out |= {"p": x["p"], "cover": cover.astype(np.int32)}
        yield _batch({k: v[sample] for k, v in out.items()})


def _stitched(batches):
    """Strings with the ranks at their own place and the next two, and the next two letters."""
    x = columns_of(batches)
    if not x:
        return
    known = x["rank"] > 0
    strings = _sorted({k: v[~known] for k, v in x.items()})
    ranked = {k: x[k][known] for k in ("s", "r", "i", "rank")}
    if not len(strings["s"]):
        return
    # One number for each string, so that a place is found by one search.
    both = np.concatenate((np.stack((strings["s"], strings["r"]), 1), np.stack((ranked["s"], ranked["r"]), 1)))
    order = np.lexsort((both[:, 1], both[:, 0]))
    new = np.concatenate(([0], np.cumsum((both[order][1:] != both[order][:-1]).any(axis=1))))
    number = np.empty(len(both), np.int64)
    number[order] = new
    own, other = number[: len(strings["s"])] << 32, number[len(strings["s"]) :] << 32
    place = other + ranked["i"]
    order = np.argsort(place, kind="stable")
    place, rank = place[order], ranked["rank"][order]

    def at(k: int) -> np.ndarray:
        want = own + strings["i"] + k
        if not len(place):
            return np.zeros(len(want), np.int64)
        found = np.minimum(np.searchsorted(place, want), len(place) - 1)
        return np.where(place[found] == want, rank[found], 0)

    one, two = _ahead(strings, 1), _ahead(strings, 2)
    out = {k: strings[k] for k in STRING}
    out |= {"b": _taken(strings["a"], one), "c": _taken(strings["a"], two)}
    # How far the first two and three letters reach.
    for name, ahead in (("two", one), ("three", two)):
        reach = _taken(strings["p"], ahead) - strings["p"] + _taken(strings["cover"], ahead)
        out[name] = np.where(ahead >= 0, reach, 0).astype(np.int32)
    out |= {"r0": np.where(strings["i"] % 3 != 0, at(0), 0), "r1": at(1), "r2": at(2)}
    yield _batch(out)


_STITCHED = f"{_LONG}, b long, c long, two int, three int, r0 long, r1 long, r2 long"


def _below(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many of the other keys are not above each row's key; keys are columns, first most."""
    keys = [np.concatenate((a, b)) for a, b in zip(others, rows, strict=True)]
    is_row = np.concatenate((np.zeros(len(others[0]), bool), np.ones(len(rows[0]), bool)))
    order = np.lexsort((is_row, *reversed(keys)))
    count = np.cumsum(~is_row[order])
    out = np.empty(len(is_row), np.int64)
    out[order] = count
    return out[len(others[0]) :]


def _strictly_below(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    keys = [np.concatenate((a, b)) for a, b in zip(rows, others, strict=True)]
    other = np.concatenate((np.zeros(len(rows[0]), bool), np.ones(len(others[0]), bool)))
    order = np.lexsort((other, *reversed(keys)))
    count = np.cumsum(other[order])
    out = np.empty(len(other), np.int64)
    out[order] = count
    return out[: len(rows[0])]


def _by_part(batches):
    """The rows of each part of batches that are sorted by part."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column("part").to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
        for first, end in zip(edges[:-1], edges[1:], strict=True):
            if held and end > first and held[0].column("part")[0].as_py() != part[first]:
                yield columns_of(iter(held))
                held = []
            if end > first:
                held.append(batch.slice(first, end - first))
    if held:
        yield columns_of(iter(held))


def _merge(batches):
    for y in _by_part(batches):
        part = y["part"][0]
        kind = y["i"] % 3
        zero, first, second = (np.flatnonzero(kind == k) for k in range(3))
        sample = np.concatenate((first, second))
        sample = sample[np.argsort(y["r0"][sample], kind="stable")]
        zero = zero[np.lexsort((y["r1"][zero], y["a"][zero]))]
        ahead = _strictly_below([y["a"][zero], y["r1"][zero]], [y["a"][first], y["r1"][first]])
        ahead += _strictly_below([y["a"][zero], y["b"][zero], y["r2"][zero]], [y["a"][second], y["b"][second], y["r2"][second]])
        place = np.concatenate((ahead * 2, np.arange(len(sample)) * 2 + 1))
        order = np.concatenate((zero, sample))[np.argsort(place, kind="stable")]
        y = {k: v[order] for k, v in y.items()}
        # Bytes that the first letters reach which a suffix shares with either neighbour. Of the
        # two ends one neighbour is in another part; what they lack is found by the exact step.
        a = y["a"][1:] == y["a"][:-1]
        b = a & (y["b"][1:] == y["b"][:-1]) & (y["b"][1:] > 0)
        c = b & (y["c"][1:] == y["c"][:-1]) & (y["c"][1:] > 0)

        def reached(mine: np.ndarray, y=y, a=a, b=b, c=c) -> np.ndarray:
            return np.where(c, y["three"][mine], np.where(b, y["two"][mine], np.where(a, y["cover"][mine], 0)))

        n = len(order)
        shared = np.zeros(n, np.int64)
        left, right = np.arange(1, n), np.arange(n - 1)
        shared[1:] = reached(left)
        shared[:-1] = np.maximum(shared[:-1], reached(right))
        out = {k: y[k] for k in ("s", "r", "i", "p", "lo", "hi", "kr", "f")}
        yield _batch(out | {"rank": (np.int64(part) << 32) + np.arange(1, n + 1), "shared": shared.astype(np.int32)})


_MERGED = "s long, r int, i int, p int, lo int, hi int, kr long, f long, rank long, shared int"


_CUT = ("r0", "a", "b", "r1", "r2", "s", "r", "i")
#: What tells two suffixes apart that stand at these places modulo 3.
_ORDER = {(0, 0): ("a", "r1"), (0, 1): ("a", "r1"), (0, 2): ("a", "b", "r2")}


def _parts(x: dict[str, np.ndarray], cuts: dict[str, np.ndarray]) -> np.ndarray:
    """How many of the cuts are not above each suffix."""
    out = np.zeros(len(x["i"]), np.int64)
    for kind in range(3):
        rows = np.flatnonzero(x["i"] % 3 == kind)
        for other in range(3):
            own = np.flatnonzero(cuts["i"] % 3 == other)
            if len(rows) and len(own):
                names = (*_ORDER.get((min(kind, other), max(kind, other)), ("r0",)), "s", "r", "i")
                out[rows] += _below([x[n][rows] for n in names], [cuts[n][own] for n in names])
    return out


def _cuts(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Every SAMPLED-th of the sampled suffixes at each place modulo 3."""
    picked = []
    for kind in range(3):
        own = np.flatnonzero(x["i"] % 3 == kind)
        names = (*_ORDER.get((kind, kind), ("r0",)), "s", "r", "i")
        picked.append(own[np.lexsort([x[n][own] for n in reversed(names)])][SAMPLED // 2 :: SAMPLED])
    picked = np.concatenate(picked)
    return {n: x[n][picked] for n in _CUT}


def _cut_again(batches):
    """Cuts each part by the samples that stand before its rows."""
    part, cuts, held = -1, None, []

    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        return {n: batch.column(n).to_numpy() for n in _CUT}

    for batch in batches:
        own = batch.column("part").to_numpy()
        row = ~batch.column("sample").to_numpy(zero_copy_only=False)
        edges = np.concatenate(([0], np.flatnonzero((own[1:] != own[:-1]) | (row[1:] != row[:-1])) + 1, [len(own)]))
        for first, end in zip(edges[:-1], edges[1:], strict=True):
            if end == first:
                continue
            if own[first] != part:
                part, cuts, held = own[first], None, []
            piece = batch.slice(first, end - first)
            if not row[first]:
                held.append(arrays(piece))
                continue
            if cuts is None:
                empty = {n: np.zeros(0, np.int64) for n in _CUT}
                cuts = _cuts({n: np.concatenate([h[n] for h in (held or [empty])]) for n in _CUT})
            finer = (int(part) << SUB_BITS) + _parts(arrays(piece), cuts)
            out = {n: piece.column(n) for n in piece.schema.names if n not in ("part", "sample")}
            yield pa.RecordBatch.from_arrays([*out.values(), pa.array(finer.astype(np.int32))], names=[*out, "part"])


def _dealt(rows: DataFrame, count: int) -> DataFrame:
    """Adds `part` by sampled suffixes and sorts by it.

    Each kind of place has cuts of its own, three times as many as parts are needed, so that a part
    holds about PART_ROWS rows at most even where the cuts of all three kinds coincide.
    """
    parts = max(1, -(-count // PART_ROWS))
    top = min(parts, TOP_PARTS)
    # The samples follow the rows, whatever their ranks.
    draw = F.pmod(F.xxhash64("s", "r", "i"), F.lit(max(1, count // (3 * top * SAMPLED))))
    picked = rows.where(draw == 0).select(*_CUT).collect() if parts > 1 else []
    cuts = _cuts({n: np.array([row[n] for row in picked], np.int64) for n in _CUT})

    def deal(batches):
        for batch in batches:
            part = _parts({n: batch.column(n).to_numpy() for n in _CUT}, cuts)
            yield batch.append_column("part", pa.array(part.astype(np.int32)))

    dealt = rows.mapInArrow(deal, f"{_STITCHED}, part int")
    if parts > top:
        finer = F.pmod(F.xxhash64("s", "r", "i", F.lit(1)), F.lit(max(1, count // (3 * parts * SAMPLED))))
        samples = dealt.where(finer == 0).withColumn("sample", F.lit(True))
        both = dealt.withColumn("sample", F.lit(False)).unionByName(samples)
        both = both.repartition(3 * top, "part").sortWithinPartitions("part", F.col("sample").desc())
        dealt = both.mapInArrow(_cut_again, f"{_STITCHED}, part int")
    return dealt.repartition(min(3 * parts, MERGE_TASKS), "part").sortWithinPartitions("part")


def sort_suffixes(strings: DataFrame) -> DataFrame:
    """Every suffix once with its rank and `shared`: bytes that it surely shares with a neighbour
    in rank. strings has the columns of STRING; the names in `a` are positive and order letters."""
    triples = stored_table(strings.repartition("s", "r").mapInArrow(_triples, "s long, r int, i int, a long, b long, c long, p int, cover int"))
    named = stored(
        triples.groupBy("a", "b", "c")
        .agg(F.count(F.lit(1)).alias("n"), F.min("cover").alias("reach"))
        .orderBy("a", "b", "c")
        .withColumn("name", F.monotonically_increasing_id() + 1)
    )
    again = named.where(f"n > 1 and c > 0 and reach < {REACH}").isEmpty()
    sample = triples.join(named.select("a", "b", "c", "name"), ["a", "b", "c"])
    if again:
        ranked = sample.select("s", "r", "i", F.col("name").alias("rank"))
    else:
        zero = F.lit(0)
        shorter = sample.select(
            "s", (F.col("r") * 2 + F.col("i") % 3 - 1).cast("int").alias("r"), (F.col("i") / 3).cast("int").alias("i"), F.col("name").alias("a"),
            "p", "cover", zero.alias("lo"), zero.alias("hi"), zero.cast("long").alias("kr"), zero.cast("long").alias("f"),
        )
        ranked = sort_suffixes(shorter).select(
            "s", F.shiftright("r", 1).alias("r"), (F.col("i") * 3 + F.col("r") % 2 + 1).cast("int").alias("i"), "rank"
        )
    empty = {n: F.lit(0).cast("long" if n in ("a", "kr", "f") else "int").alias(n) for n in STRING if n not in ("s", "r", "i")}
    both = strings.select(*STRING, F.lit(0).cast("long").alias("rank")).unionByName(ranked.select("s", "r", "i", *empty.values(), "rank"))
    stitched = stored_table(both.repartition("s", "r").mapInArrow(_stitched, _STITCHED))
    return stored_table(_dealt(stitched, stitched.count()).mapInArrow(_merge, _MERGED))
