"""Numbers from text, shares and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patio.functions import text as tx

DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"


def try_integer(text: Column, kind: str = "int") -> Column:
    return F.nullif(F.trim(text), F.lit("")).try_cast(kind)


def try_decimal(text: Column, kind: str = "decimal(10,2)") -> Column:
    """Comma or dot as the decimal sign; anything else, or too large, gives NULL."""
    dotted = F.replace(F.trim(text), F.lit(","), F.lit("."))
    return F.when(dotted.rlike(DECIMAL_TEXT), dotted.try_cast(kind))


def payment_amount(text: Column) -> Column:
    """Bank file amount: optional currency sign and blanks."""
    return try_decimal(tx.strip_chars(text, "$ "), "decimal(10,2)")


def grouped_integer(text: Column) -> Column:
    """Whole number written with thousands marks: `1.281` and `1,281` are 1281."""
    return try_integer(F.translate(text, ".,", ""))


def mixed_locale_amount(text: Column, kind: str = "decimal(12,2)") -> Column:
    """Amount whose marks follow no single locale.

    A mark before the last two digits is the decimal sign; all other marks only group digits.
    """
    digits = F.regexp_replace(text, "[^0-9]", "")
    cents = text.rlike(r"[.,][0-9]{2}\s*$")
    plain = F.when(cents, F.regexp_replace(digits, "([0-9]{2})$", ".$1")).otherwise(digits)
    sign = F.when(F.trim(text).startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.when(digits != "", F.concat(sign, plain).try_cast(kind))


def account_number(text: Column) -> Column:
    """Account cell: drop the leading word, blanks and dots; keep it only when it is a number."""
    low = F.replace(F.lower(F.trim(text)), F.lit("cuenta "), F.lit(""))
    bare = F.nullif(F.translate(low, " .", ""), F.lit(""))
    return F.when(bare.try_cast("bigint").isNotNull(), bare)


def floor_number(text: Column) -> Column:
    """Ground floor becomes NULL, as does anything that is no small number."""
    bare = F.regexp_replace(F.trim(text), f"(?i){tx.GROUND_FLOOR}", "")
    return F.nullif(bare, F.lit("")).try_cast("smallint")


def money(value: Column) -> Column:
    return F.round(value, 2)


def percent_of(part: Column, whole: Column) -> Column:
    """Exact percentage as DECIMAL(26,12); 0 when there is nothing to share."""
    p, w = part.cast("decimal(10,0)"), whole.cast("decimal(10,0)")
    share = (p * F.expr("100.0BD")) / F.nullif(w, F.lit(0).cast("decimal(10,0)"))
    return F.coalesce(share, F.lit(0)).cast("decimal(26,12)")


def fraction_of(part: Column, whole: Column) -> Column:
    """The same percentage as a fraction; 15 digits are enough and keep it a plain long."""
    return (percent_of(part, whole) * F.expr("0.01BD")).cast("decimal(15,14)")


def apply_fraction(amount: Column, fraction: Column) -> Column:
    """Exact product of a DECIMAL(12,2) amount, rounded half up to cents."""
    share = F.coalesce(amount, F.lit(0)).cast("decimal(12,2)") * fraction
    return F.round(share, 2).cast("decimal(12,2)")


def positive_part(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("decimal(18,2)"))


def negative_part(value: Column) -> Column:
    return F.greatest(-value, F.lit(0).cast("decimal(18,2)"))
