"""Spreadsheet sheets, read from a delimited export (the container format is not parsed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.schemas import RAW_GROUPS
from patio.sources.delimited import read_delimited


def read_sheet(
    spark: SparkSession, path: str, columns: Sequence[str] = RAW_GROUPS, sep: str = ","
) -> DataFrame:
    """A sheet with a header row, by column order, all cells as text."""
    return read_delimited(spark, path, sep, columns, header=True)


def read_sheet_range(
    spark: SparkSession,
    path: str,
    first_row: int,
    last_row: int | None,
    first_col: int,
    n_cols: int,
    sep: str = ",",
) -> DataFrame:
    """A cell range without header as F1..Fn; without a last row it goes to the end.

    The export carries the sheet's row number in front, because the order in which files are
    read says nothing; column 1 is the sheet's column A.
    """
    width = first_col + n_cols - 1
    names = ["fila"] + [f"c{i}" for i in range(1, width + 1)]
    cells = read_delimited(spark, path, sep, names, header=False)
    row = F.col("fila").try_cast("bigint")
    inside = row >= first_row if last_row is None else row.between(first_row, last_row)
    return cells.filter(inside).select(
        *[F.col(f"c{first_col + i}").alias(f"F{i + 1}") for i in range(n_cols)]
    )
