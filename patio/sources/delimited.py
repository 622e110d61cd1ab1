"""Delimited text with a header, every column as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.schemas import (
    RAW_PAYMENTS,
    RAW_PERSONS,
    RAW_UNIT_ACCOUNTS,
    RAW_UNITS,
    text_schema,
)

# Quotes are ordinary characters; the cleaning expressions remove them. A short line gives
# NULLs, and CRLF, LF and CR all end a line.
READ_OPTIONS = {
    "quote": "",
    "escape": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
}

# Column order and separator of each raw file.
LAYOUTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "payments": (",", RAW_PAYMENTS),
    "unit_accounts": ("|", RAW_UNIT_ACCOUNTS),
    "persons": (";", RAW_PERSONS),
    "units": ("\t", RAW_UNITS),
}


def read_delimited(
    spark: SparkSession, path: str, sep: str, columns: Sequence[str], header: bool = True
) -> DataFrame:
    return (
        spark.read.options(**READ_OPTIONS)
        .option("sep", sep)
        .option("header", header)
        .schema(text_schema(list(columns)))
        .csv(path)
    )


def read_raw(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """One of the known raw files: payments, unit_accounts, persons or units."""
    sep, columns = LAYOUTS[kind]
    return read_delimited(spark, path, sep, columns)


def write_delimited(df: DataFrame, path: str, sep: str, header: bool = True) -> None:
    """Text columns as they are, without quoting, one header per file."""
    (
        df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns])
        .write.mode("errorifexists")
        .options(
            sep=sep,
            header=header,
            quote="",
            emptyValue="",
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
        .csv(path)
    )
