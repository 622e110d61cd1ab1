"""Holiday calendar of one year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.functions.dates import parse_date
from patio.operators.dedup import keep_one
from patio.sources.delimited import read_delimited

COLUMNS = ("fecha", "tipo", "nombre")


def load_holidays(spark: SparkSession, path: str, year: int, sep: str = ",") -> DataFrame:
    """Holidays of the year, each date once; replaces the stored table as a whole."""
    raw = read_delimited(spark, path, sep, COLUMNS)
    typed = raw.select(parse_date(F.col("fecha")).alias("fecha"), "tipo", "nombre")
    return keep_one(typed.filter(F.year("fecha") == year), ["fecha"])


def with_is_holiday(days: DataFrame, column: str, holidays: DataFrame, name: str = "es_feriado") -> DataFrame:
    """1 for a holiday, 0 for any other day."""
    marks = holidays.select(F.col("fecha").alias("_fecha")).distinct()
    flag: Column = F.when(F.col("_fecha").isNotNull(), 1).otherwise(0)
    return days.join(marks, F.col(column) == F.col("_fecha"), "left").select(
        *days.columns, flag.alias(name)
    )
