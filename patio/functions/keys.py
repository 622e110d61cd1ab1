"""Keys for matching text and for naming charges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Room for year * 12 + month below the unit number.
MONTH_SLOTS = 100_000


def match_key(text: Column) -> Column:
    """Names are equal when they differ only in case or trailing blanks."""
    return F.lower(F.rtrim(text))


def charge_id(unit: Column, period: Column) -> Column:
    """One number per (unit, month), computed without any global counter."""
    month = F.year(period) * 12 + F.month(period) - 1
    return unit.cast("bigint") * F.lit(MONTH_SLOTS).cast("bigint") + month.cast("bigint")

