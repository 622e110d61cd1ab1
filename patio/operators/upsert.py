"""Insert-if-new, upsert and fill jobs that yield the next state of a table.

The change set is measured (`Changes`): one of at most MOST_BYTES is broadcast, and the target is
only scanned. For a larger one a bitmap of its keys, whose size is fixed, is broadcast instead:
target rows outside of it surely have no match and pass by the join, so only the others are
shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.functions.keys import match_key
from patio.operators.dedup import key_columns, repeated_keys

OVERWRITE = "overwrite"
COALESCE = "coalesce"


class RepeatedKeyError(ValueError):
    """The change set would hit one target row more than once."""


def _same_key(target: DataFrame, source: DataFrame, keys: Sequence[str], fold: Sequence[str]) -> Column:
    def side(df: DataFrame, k: str) -> Column:
        return match_key(df[k]) if k in fold else df[k]

    return reduce(lambda a, b: a & b, [side(target, k) == side(source, k) for k in keys])


#: Largest change set that is broadcast.
MOST_BYTES = 32 << 20
#: Bits of the bitmap of keys, in words of 64: at most 2^20 rows are broadcast.
BITS = 1 << 26


def is_small(changes: DataFrame) -> bool:
    """Whether a change set is of at most MOST_BYTES, by one aggregate over it."""
    texts = [F.col(f"`{f.name}`") for f in changes.schema.fields if f.dataType.typeName() in ("string", "binary")]
    width = F.lit(16 * len(changes.columns) + 16)
    for text in texts:
        width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return changes.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0] <= MOST_BYTES


def marked(target: DataFrame, columns: Sequence[Column], wanted: DataFrame) -> DataFrame:
    """Target with `_maybe`: false where its key is surely not among `wanted` (key columns only).

    The keys' hashes are one bitmap of BITS bits, whatever their number.
    """
    place = F.pmod(F.xxhash64(*wanted.columns), F.lit(BITS)).alias("_h")
    bit = F.expr("shiftleft(1L, cast(_h % 64 as int))")
    word = F.floor(F.col("_h") / 64)
    words = wanted.select(place).groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    hashed = target.withColumn("_h", F.pmod(F.xxhash64(*columns), F.lit(BITS)))
    held = hashed.join(F.broadcast(words), F.floor(F.col("_h") / 64) == F.col("_word"), "left")
    found = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return held.select(*target.columns, found.alias("_maybe"))


def _comparable(target: DataFrame, columns: Sequence[Column], wanted: DataFrame) -> bool:
    """Equal keys have equal hashes only where their types are the same."""
    types = [f.dataType for f in target.select(*columns).schema.fields]
    return types == [f.dataType for f in wanted.schema.fields]


def new_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    fold: Sequence[str] = (),
    small: bool | None = None,
) -> DataFrame:
    """Rows of `source` whose key the target does not have.

    The target is first cut to the keys that the source holds. `small` tells whether the source
    may be broadcast for that; by default it is measured.
    """
    places = list(enumerate(key_columns(keys, fold)))
    wanted = source.select(*[c.alias(f"_w{i}") for i, c in places])
    stored = target.select(*[c.alias(f"_k{i}") for i, c in places])
    same = [F.col(f"_k{i}") == F.col(f"_w{i}") for i, _ in places]
    if is_small(wanted) if small is None else small:
        known = stored.join(F.broadcast(wanted), same, "left_semi")
    else:
        own = [F.col(f"_k{i}") for i, _ in places]
        if _comparable(stored, own, wanted):
            stored = marked(stored, own, wanted).filter("_maybe").drop("_maybe")
        known = stored.join(wanted.distinct(), same, "left_semi")
    return source.join(known, [c == F.col(f"_k{i}") for i, c in places], "left_anti")


def shaped_like(target: DataFrame, rows: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Rows with exactly the target's columns; missing ones get a default or NULL."""
    defaults = defaults or {}
    wanted = []
    for field in target.schema.fields:
        if field.name in rows.columns:
            value = F.col(field.name)
            if field.name in defaults:
                value = F.coalesce(value, defaults[field.name])
        else:
            value = defaults.get(field.name, F.lit(None))
        wanted.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*wanted)


def insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    fold: Sequence[str] = (),
    defaults: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(inserted rows, next target). The first part is what an insert would return."""
    inserted = shaped_like(target, new_rows(target, source, keys, fold), defaults)
    return inserted, target.unionByName(inserted)


def update_matched(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    policy: str = OVERWRITE,
    columns: Sequence[str] | None = None,
    fold: Sequence[str] = (),
    small: bool | None = None,
) -> DataFrame:
    """Target with the source's values on matching keys.

    `overwrite` takes them even when NULL, `coalesce` keeps the old value then.
    """
    if policy not in (OVERWRITE, COALESCE):
        raise ValueError(f"unknown policy: {policy}")
    changed = [c for c in (columns or source.columns) if c not in keys and c in target.columns]
    incoming = source.select(
        *[c.alias(f"_k{i}") for i, c in enumerate(key_columns(keys, fold))],
        *[F.col(c).alias(f"_new_{c}") for c in changed],
        F.lit(True).alias("_hit"),
    )
    own = key_columns(keys, fold)
    same = [c == F.col(f"_k{i}") for i, c in enumerate(own)]
    passing = None
    if is_small(incoming) if small is None else small:
        joined = target.join(F.broadcast(incoming), same, "left")
    else:
        wanted = incoming.select(*[f"_k{i}" for i, _ in enumerate(own)])
        if _comparable(target, own, wanted):
            told = marked(target, own, wanted)
            passing = told.filter("NOT _maybe").drop("_maybe")
            target = told.filter("_maybe").drop("_maybe")
        joined = target.join(incoming, same, "left")
    result = []
    for field in target.schema.fields:
        value = F.col(field.name)
        if field.name in changed:
            fresh = F.col(f"_new_{field.name}").cast(field.dataType)
            value = (
                F.coalesce(fresh, value)
                if policy == COALESCE
                else F.when(F.col("_hit"), fresh).otherwise(value)
            )
        result.append(value.alias(field.name))
    updated = joined.select(*result)
    return updated if passing is None else updated.unionByName(passing)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    policy: str = OVERWRITE,
    columns: Sequence[str] | None = None,
    defaults: dict[str, Column] | None = None,
    fold: Sequence[str] = (),
) -> DataFrame:
    """Update the matches and insert the rest; `source` holds each key once."""
    small = is_small(source)
    updated = update_matched(target, source, keys, policy, columns, fold, small)
    inserted = shaped_like(target, new_rows(target, source, keys, fold, small), defaults)
    return updated.unionByName(inserted)


def assert_unique(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same frame, or an error naming a few repeated keys."""
    sample = repeated_keys(source, keys).limit(5).collect()
    if sample:
        raise RepeatedKeyError(f"{list(keys)} repeated, for example {[tuple(r) for r in sample]}")
    return source


def fill_null_from(
    target: DataFrame, lookup: DataFrame, on: Sequence[str], column: str, value: str
) -> DataFrame:
    """Fill `column` from `lookup.value` only where it is NULL.

    Rows that already have a value skip the join: they neither shuffle nor pile up on NULL.
    `lookup` holds each key once.
    """
    have = target.filter(F.col(column).isNotNull())
    found = lookup.select(*on, F.col(value).alias("_value"))
    lacking = (
        target.filter(F.col(column).isNull())
        .join(found, list(on), "left")
        .withColumn(column, F.col("_value").cast(target.schema[column].dataType))
        .select(*target.columns)
    )
    return have.unionByName(lacking)
