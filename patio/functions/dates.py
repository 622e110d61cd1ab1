"""Dates from text and calendar steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names as they appear in the monthly amounts.
MONTHS = (
    "enero",
    "febrero",
    "marzo",
    "abril",
    "mayo",
    "junio",
    "julio",
    "agosto",
    "septiembre",
    "octubre",
    "noviembre",
    "diciembre",
)


#: Day, month and year with one separator, and a time of day or none.
DAY_FIRST = r"^([0-9]{1,2})([/.-])([0-9]{1,2})\2([0-9]{4})(?: +[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)?$"
COMPACT = r"^[0-9]{8}$"
#: Year, month and day; a month alone is no date.
YEAR_FIRST = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def parse_date(text: Column) -> Column:
    """Day, month and year with / . or - between, yyyyMMdd, or ISO; each but the second with or
    without a time of day.

    The pattern decides which parser runs: a parser that meets a foreign format raises and
    catches an error for every row.
    """
    bare = F.trim(text)
    slashed = F.regexp_replace(bare, DAY_FIRST, "$1/$3/$4")
    return (
        F.when(bare.rlike(DAY_FIRST), F.try_to_date(slashed, "d/M/yyyy"))
        .when(bare.rlike(COMPACT), F.try_to_date(bare, "yyyyMMdd"))
        .when(bare.rlike(YEAR_FIRST), bare.try_cast("timestamp_ntz").cast("date"))
    )


def month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, i)])
    return F.try_element_at(table, F.lower(F.trim(name)))


def period_of(year: int | Column, month: Column) -> Column:
    """First day of the month, NULL when the month is unknown."""
    y = year if isinstance(year, Column) else F.lit(year)
    return F.make_date(y, month, F.lit(1))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_start(day: Column) -> Column:
    """Monday of the week, where a Sunday already counts for the next one."""
    return F.date_trunc("week", F.date_add(day, 1)).cast("date")


def in_range(df: DataFrame, column: str, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Closed date range on the bare column, so that the scan can use it.

    A table stored by month of this column also skips whole folders.
    """
    lo, hi = F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")
    day = F.col(column)
    kept = df.filter((day >= lo) & (day < F.date_add(hi, 1)))
    month = month_column(column)
    if month in df.columns:
        kept = kept.filter(F.col(month).between(F.trunc(lo, "month"), F.trunc(hi, "month")))
    return kept


def stored_month(df: DataFrame, other: DataFrame, column: str = "periodo") -> list[str]:
    """The month both tables are stored by, if they are, as a further join key.

    A cut of one side by its dates then skips folders of the other side as well.
    """
    month = month_column(column)
    return [month] if month in df.columns and month in other.columns else []


def month_column(column: str) -> str:
    """Name of the folder column a table is stored by."""
    return f"{column}_mes"


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    first = dt.date(year, month, 1)
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return first, following - dt.timedelta(days=1)
