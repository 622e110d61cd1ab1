"""Cleaning of text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = "\u00a0"
# Labels the reports and checks compare with.
TENANT = "Inquilino"
OWNER = "Propietario"
GROUND_FLOOR = "PB"
EXTRAORDINARY = "Extraordinario"
ORDINARY = "Ordinario"


def trimmed(text: Column) -> Column:
    """Blanks off both ends; a no-break space stays."""
    return F.trim(text)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def strip_chars(text: Column, chars: str) -> Column:
    return F.translate(F.trim(text), chars, "")


def stripped_or_null(text: Column, chars: str) -> Column:
    return F.nullif(strip_chars(text, chars), F.lit(""))


def truncate(text: Column, length: int) -> Column:
    return F.left(text, F.lit(length))


def digits_only(text: Column) -> Column:
    """True for digits and for empty text, unknown for NULL."""
    return ~text.rlike("[^0-9]")


def yes_flag(text: Column) -> Column:
    return F.coalesce(F.upper(F.trim(text)) == F.lit("SI"), F.lit(False))


def tenure_label(code: Column) -> Column:
    return F.when(strip_chars(code, '"') == "1", F.lit(TENANT)).otherwise(F.lit(OWNER))


def origin_label(kind: Column) -> Column:
    """Everything that is not extraordinary, also NULL, is ordinary."""
    return F.when(
        F.lower(F.rtrim(kind)) == EXTRAORDINARY.lower(), F.lit(EXTRAORDINARY)
    ).otherwise(F.lit(ORDINARY))


def is_extraordinary(kind: Column) -> Column:
    return F.coalesce(F.lower(F.rtrim(kind)) == EXTRAORDINARY.lower(), F.lit(False))
