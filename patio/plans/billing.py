"""Invoices, balances and send dates of monthly charges."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patio.functions import dates, numbers
from patio.functions.text import is_extraordinary
from patio.operators import joins
from patio.schemas import MONEY

DUE_DAYS = 10
SEND_HORIZON = 10


class MonthBill(NamedTuple):
    """New invoices and statements, and all charges of the month with their send date."""

    invoices: DataFrame
    statements: DataFrame
    charges: DataFrame


def new_invoices(
    charges: DataFrame, details: DataFrame, invoices: DataFrame, issue_date: dt.date | str
) -> DataFrame:
    """An invoice for each charge without one.

    Without lines the ordinary total is NULL and the extraordinary one 0.
    """
    extra = is_extraordinary(F.col("categoria"))
    zero = F.lit(0).cast(MONEY)
    # Lines shrink to one row per charge while they are scanned.
    month = dates.stored_month(charges, details)
    totals = details.groupBy(F.col("idExpensa").alias("id"), *month).agg(
        F.sum(F.when(extra, zero).otherwise(F.col("importe"))).alias("_ord"),
        F.sum(F.when(extra, F.col("importe")).otherwise(zero)).alias("_ext"),
    )
    issued = F.lit(str(issue_date)).cast("date")
    known = dates.stored_month(charges, invoices)
    billed = invoices.select(F.col("idExpensa").alias("id"), *known)
    open_charges = charges.select("id", "periodo", *{*month, *known}).join(billed, ["id", *known], "left_anti")
    return open_charges.join(totals, ["id", *month], "left").select(
        # A charge has one invoice, which takes its number.
        F.col("id").alias("numeroFactura"),
        F.col("id").alias("idExpensa"),
        issued.alias("fechaEmision"),
        F.date_add(issued, DUE_DAYS).alias("fechaVencimiento"),
        F.lit(1).alias("nroVencimiento"),
        zero.alias("interesPorMora"),
        F.col("_ord").cast(MONEY).alias("totalGastoOrdinario"),
        F.coalesce(F.col("_ext"), zero).cast(MONEY).alias("totalGastoExtraordinario"),
        "periodo",
    )


def _statement(df: DataFrame) -> DataFrame:
    """Statement columns from `saldoAnterior`, `montoTotal` and `pagosPeriodo`."""
    balance = F.col("saldoAnterior") + F.col("montoTotal") - F.col("pagosPeriodo")
    return df.withColumn("saldoNuevo", balance.cast(MONEY)).select(
        F.col("id").alias("idExpensa"),
        "idUF",
        "periodo",
        F.col("saldoAnterior").cast(MONEY).alias("saldoAnterior"),
        "saldoNuevo",
        numbers.positive_part(F.col("saldoNuevo")).alias("saldoDeudor"),
        numbers.negative_part(F.col("saldoNuevo")).alias("saldoAdelantado"),
        F.col("saldoNuevo").alias("saldoTotal"),
    )


def latest_balances(balances: DataFrame, statements: DataFrame) -> DataFrame:
    """The latest statement of each unit, after new statements have come."""
    columns = ["idUF", "periodo", "saldoTotal"]
    both = balances.select(*columns).unionByName(statements.select(*columns))
    return both.groupBy("idUF").agg(F.max("periodo").alias("periodo"), F.max_by("saldoTotal", "periodo").alias("saldoTotal"))


def balance_of(charges: DataFrame, balances: DataFrame, same_month: DataFrame) -> DataFrame:
    """Charges of a month with their unit's balance before it, 0 without one."""
    recent = balances.select("idUF", "periodo", "saldoTotal").unionByName(same_month.select("idUF", "periodo", "saldoTotal"))
    found = joins.asof_before(charges, recent, "idUF", "periodo", ["saldoTotal"])
    return found.withColumn("saldoAnterior", F.coalesce("prev_saldoTotal", F.lit(0))).drop("prev_saldoTotal")


def previous_balance(charges: DataFrame, statements: DataFrame, first: dt.date) -> DataFrame:
    """Charges with the balance of the unit's latest earlier statement, 0 without one.

    Statements of earlier months are folded to the latest per unit while they are scanned.
    """
    start = F.lit(str(first)).cast("date")
    earlier = statements.filter(F.col("periodo") < start)
    latest = earlier.groupBy("idUF").agg(F.max("periodo").alias("periodo"), F.max_by("saldoTotal", "periodo").alias("saldoTotal"))
    return balance_of(charges, latest, statements.filter(F.col("periodo") >= start))


def new_statements(
    charges: DataFrame,
    payments: DataFrame,
    statements: DataFrame,
    year: int,
    month: int,
    balances: DataFrame | None = None,
) -> DataFrame:
    """A statement for each charge of the month without one."""
    first, last = dates.month_bounds(year, month)
    done = dates.in_range(statements, "periodo", first, last).select(F.col("idExpensa").alias("_charge"))
    pending = (
        charges.select("id", "idUF", "periodo", "montoTotal")
        .join(done, F.col("id") == F.col("_charge"), "left_anti")
    )
    if balances is None:
        with_balance = previous_balance(pending, statements, first)
    else:
        with_balance = balance_of(pending, balances, dates.in_range(statements, "periodo", first, last))
    paid = dates.in_range(payments, "fechaPago", first, last)
    return _statement(
        joins.sum_or_zero(with_balance, paid, "idUF", "nroUnidadFuncional", "monto", "pagosPeriodo")
    )


def with_send_date(
    charges: DataFrame, holidays: DataFrame, issue_date: dt.date | str, skip_weekends: bool = False
) -> DataFrame:
    """The first day from the issue date on that is no holiday, within ten days, or NULL."""
    issued = charges.sparkSession.range(1).select(F.lit(str(issue_date)).cast("date").alias("dia"))
    free = joins.next_free_days(issued, "dia", holidays, SEND_HORIZON, skip_weekends)
    return charges.withColumn("fechaEnvio", free.agg(F.max("dia_habil")).scalar())


def bill_month(
    charges: DataFrame,
    details: DataFrame,
    payments: DataFrame,
    invoices: DataFrame,
    statements: DataFrame,
    holidays: DataFrame,
    year: int,
    month: int,
    issue_date: dt.date | str,
    skip_weekends: bool = False,
    balances: DataFrame | None = None,
) -> MonthBill:
    """Bill one month. Running it again adds nothing and only sets the send date anew.

    With `balances`, the latest statement of each unit, all before the month, earlier statements
    are not read.
    """
    first, last = dates.month_bounds(year, month)
    due = dates.in_range(charges, "periodo", first, last)
    return MonthBill(
        new_invoices(due, details, invoices, issue_date),
        new_statements(due, payments, statements, year, month, balances),
        with_send_date(due, holidays, issue_date, skip_weekends),
    )


def bill_history(charges: DataFrame, payments: DataFrame) -> DataFrame:
    """Statements of all months at once, as billing every month in order would give.

    Payments shrink to one row per unit and month, and a unit has one charge per month, so the
    running window holds at most the months of the history.
    """
    paid = (
        payments.filter(F.col("nroUnidadFuncional").isNotNull())
        .groupBy(
            F.col("nroUnidadFuncional").alias("idUF"),
            dates.month_start(F.col("fechaPago")).alias("_mes"),
        )
        .agg(F.sum("monto").alias("_pagos"))
    )
    monthly = (
        charges.select(
            "id", "idUF", "periodo", "montoTotal", dates.month_start(F.col("periodo")).alias("_mes")
        )
        .join(paid, ["idUF", "_mes"], "left")
        .withColumn("pagosPeriodo", F.coalesce(F.col("_pagos"), F.lit(0)).cast("decimal(28,2)"))
    )
    earlier = Window.partitionBy("idUF").orderBy("periodo").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("montoTotal") - F.col("pagosPeriodo")
    previous = F.coalesce(F.sum(step).over(earlier), F.lit(0))
    return _statement(monthly.withColumn("saldoAnterior", previous.cast("decimal(28,2)")))
