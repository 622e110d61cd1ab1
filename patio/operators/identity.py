"""Surrogate numbers for new rows without a counter and without one global sort task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patio.session import materialize

# Rows of one partition are numbered in the low bits of the partition-wide id.
ROW_BITS = 33


def number_rows(
    rows: DataFrame, target: DataFrame, id_column: str, order_by: Sequence[str]
) -> DataFrame:
    """Add `id_column`: the highest id of `target` plus the rank by `order_by`.

    Rows are range-partitioned by the (unique) order columns and numbered inside each
    partition; only one count per partition is summed to shift them.
    """
    placed = materialize(
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_pos"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    highest = target.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()
    # One row per partition: the bound is the partition count of this frame.
    return placed.join(F.broadcast(shifts), "_part").select(
        (highest + F.col("_shift") + F.col("_pos") + 1).alias(id_column),
        *[F.col(c) for c in rows.columns],
    )
