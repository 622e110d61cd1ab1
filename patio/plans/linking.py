"""Ties waiting payments to units whose account changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.operators.joins import account_owner
from patio.operators.upsert import fill_null_from
from patio.schemas import WAITING

UNIT = "nroUnidadFuncional"


def link_payments(payments: DataFrame, changed: DataFrame) -> DataFrame:
    """All payments, where those without unit take the lowest changed unit with their account.

    A payment that has a unit never moves.
    """
    return fill_null_from(payments, account_owner(changed), ["cbu"], UNIT, "idUF")


def newly_linked(payments: DataFrame, changed: DataFrame) -> DataFrame:
    """Only the payments that `link_payments` would tie."""
    waiting = payments.filter(F.col(UNIT).isNull())
    if WAITING in payments.columns:
        # Stored payments without unit lie in folders of their own.
        waiting = waiting.filter(F.col(WAITING))
    return fill_null_from(waiting, account_owner(changed), ["cbu"], UNIT, "idUF").filter(
        F.col(UNIT).isNotNull()
    )
