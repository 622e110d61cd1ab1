"""Rows that share a key.

Every function aggregates, so equal keys shrink before the shuffle and no task ever has to
sort or hold all rows of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.functions.keys import match_key


def key_columns(keys: Sequence[str], fold: Sequence[str] = ()) -> list[Column]:
    """Key columns; names in `fold` match regardless of case and trailing blanks."""
    return [match_key(F.col(k)) if k in fold else F.col(k) for k in keys]


def _named_keys(keys: Sequence[str], fold: Sequence[str]) -> list[Column]:
    return [c.alias(f"_k{i}") for i, c in enumerate(key_columns(keys, fold))]


def keep_one(df: DataFrame, keys: Sequence[str], fold: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest over all columns, so reruns agree."""
    rest = [c for c in df.columns if c not in keys or c in fold]
    lowest = F.min(F.struct(*rest)).alias("_row")
    picked = df.groupBy(*_named_keys(keys, fold)).agg(lowest)
    place = {k: f"_k{i}" for i, k in enumerate(keys)}
    return picked.select(
        *[
            (F.col(f"_row.`{c}`") if c in rest else F.col(place[c])).alias(c)
            for c in df.columns
        ]
    )


def split_repeated(
    df: DataFrame, keys: Sequence[str], fold: Sequence[str] = (), carried: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(one row per key, all other rows with how many copies each has).

    `carried` columns (such as the raw row as text) are part of the other rows only. They do not
    choose the row that is kept, and they are computed for keys that occur more than once alone.
    """
    plain = df.drop(*carried)
    kept = keep_one(plain, keys, fold)
    names = [f"_k{i}" for i in range(len(keys))]
    many = plain.groupBy(*_named_keys(keys, fold)).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    same_key = [c.eqNullSafe(F.col(n)) for c, n in zip(key_columns(keys, fold), names, strict=True)]
    again = df.join(many, same_key, "left_semi")
    columns = df.columns
    copies = again.groupBy(*columns).agg(F.count(F.lit(1)).alias("copias"))
    first = keep_one(again.select(*plain.columns, *carried), keys, fold)
    mark = first.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)], F.lit(1).alias("_one"))
    # Whole rows are compared: they are distinct on both sides, so no value is hot.
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(columns)]
    left = F.col("copias") - F.coalesce(F.col("_one"), F.lit(0))
    rest = (
        copies.join(mark, same, "left")
        .withColumn("copias", left)
        .filter(F.col("copias") > 0)
        .select(*columns, "copias")
    )
    return kept, rest


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cantidad")).filter("cantidad > 1")


def drop_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only rows whose key occurs once; a repeated key loses all its rows."""
    rest = [c for c in df.columns if c not in keys]
    once = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_row")
    )
    return once.filter("_n = 1").select(
        *[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    )


def rows_of_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows `drop_repeated` leaves out."""
    return df.join(repeated_keys(df, keys).select(*keys), list(keys), "left_semi")
