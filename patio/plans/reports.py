"""Management reports.

Every report reduces the payments or charge lines per unit (or charge) and calendar bucket
before it looks at any other table. A unit with a large part of all rows is thus folded while
it is scanned, and the joins see a few rows per unit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.functions import dates
from patio.functions.keys import match_key
from patio.functions.text import TENANT, is_extraordinary
from patio.session import materialize
from patio.sources import xml

Day = dt.date | str
ROOT_MONTHS = "RecaudacionMesDepto"
ROOT_PAYMENTS = "PagosUF"


def _unit_rows(units: DataFrame, group_id: int | None, *columns: str) -> DataFrame:
    kept = units if group_id is None else units.filter(F.col("idConsorcio") == group_id)
    return kept.select("idUF", *columns)


def _linked_payments(payments: DataFrame, first: Day, last: Day) -> DataFrame:
    """Payments of the range that belong to a unit; the others would only pile up on NULL."""
    return dates.in_range(payments, "fechaPago", first, last).filter(
        F.col("nroUnidadFuncional").isNotNull()
    )


def _paid_per_unit(payments: DataFrame, first: Day, last: Day, bucket: Column, name: str) -> DataFrame:
    return (
        _linked_payments(payments, first, last)
        .groupBy(F.col("nroUnidadFuncional").alias("idUF"), bucket.alias(name))
        .agg(F.sum("monto").alias("monto"))
    )


def weekly_cashflow(
    payments: DataFrame, units: DataFrame, date_from: Day, date_to: Day, group_id: int | None = None
) -> DataFrame:
    """Weekly income with the period's average week and the running total.

    Only weeks with payments appear, and the average is over those.
    """
    paid = _paid_per_unit(payments, date_from, date_to, dates.week_start(F.col("fechaPago")), "semana_ini")
    weeks = (
        paid.join(_unit_rows(units, group_id), "idUF", "left_semi")
        .groupBy("semana_ini")
        .agg(F.sum("monto").alias("total_semana"))
    )
    # From here on there is one row per week of the range.
    every = Window.partitionBy()
    so_far = Window.orderBy("semana_ini").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return weeks.select(
        "semana_ini",
        F.date_add("semana_ini", 6).alias("semana_fin"),
        "total_semana",
        F.avg("total_semana").over(every).alias("promedio_periodo"),
        F.sum("total_semana").over(so_far).alias("acumulado"),
    ).orderBy("semana_ini")


def _month_totals(
    payments: DataFrame,
    units: DataFrame,
    groups: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None,
) -> DataFrame:
    """Income per group name, apartment and month."""
    paid = _paid_per_unit(payments, date_from, date_to, dates.month_key(F.col("fechaPago")), "mes")
    per_group = (
        paid.join(_unit_rows(units, group_id, "idConsorcio", "departamento"), "idUF")
        .groupBy("idConsorcio", "departamento", "mes")
        .agg(F.sum("monto").alias("monto"))
    )
    named = groups.select(F.col("id").alias("idConsorcio"), F.col("nombre").alias("consorcio"))
    return per_group.join(named, "idConsorcio").select("consorcio", "departamento", "mes", "monto")


def month_column_name(month: str) -> str:
    return "m_" + month.replace("-", "_")


def month_by_apartment(
    payments: DataFrame,
    units: DataFrame,
    groups: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None = None,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """Income per group name and apartment with one column `m_YYYY_MM` per month.

    Without `months` the columns are those months of the range that have income: a first job
    stores the monthly totals and returns the month names, at most one per month of the range.
    """
    totals = _month_totals(payments, units, groups, date_from, date_to, group_id)
    if months is None:
        totals = materialize(totals)
        months = sorted(r[0] for r in totals.select("mes").distinct().collect())
    # Names merge when they differ only in case or trailing blanks.
    folded = totals.groupBy(
        match_key(F.col("consorcio")).alias("_grupo"), match_key(F.col("departamento")).alias("_depto")
    )
    labels = [F.min("consorcio").alias("consorcio"), F.min("departamento").alias("departamento")]
    amount = F.lit(0).cast("decimal(38,2)")
    cells = [
        F.coalesce(F.sum(F.when(F.col("mes") == m, F.col("monto"))), amount).alias(month_column_name(m))
        for m in months
    ]
    wide = folded.agg(*labels, *cells).drop("_grupo", "_depto")
    return wide.orderBy("consorcio", "departamento")


def month_by_apartment_xml(wide: DataFrame) -> DataFrame:
    return xml.to_xml_rows(wide, "row", {"departamento": "depto"})


def by_origin(
    charges: DataFrame,
    details: DataFrame,
    units: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None = None,
    origin_col: str = "tipo",
) -> DataFrame:
    """Charged amounts per month, split into ordinary and extraordinary."""
    monthly = _charged_per_month(
        dates.in_range(charges, "periodo", date_from, date_to),
        details,
        units,
        group_id,
        origin_col,
    )
    return monthly.select(
        F.col("mes").alias("periodo"),
        F.col("ordinario").alias("Ordinario"),
        F.col("extraordinario").alias("Extraordinario"),
        F.col("total").alias("Total"),
    ).orderBy("periodo")


def _charged_per_month(
    charges: DataFrame, details: DataFrame, units: DataFrame, group_id: int | None, origin_col: str
) -> DataFrame:
    """Lines belong to the months of their charges, whatever the charge ids are."""
    zero = F.lit(0).cast("decimal(18,2)")
    extra = is_extraordinary(F.col(origin_col))
    month = dates.stored_month(charges, details)
    per_charge = details.groupBy(F.col("idExpensa").alias("id"), *month).agg(
        F.sum(F.when(extra, zero).otherwise(F.col("importe"))).alias("ordinario"),
        F.sum(F.when(extra, F.col("importe")).otherwise(zero)).alias("extraordinario"),
    )
    per_unit = (
        charges.select("id", "idUF", dates.month_start(F.col("periodo")).alias("mes"), *month)
        .join(per_charge, ["id", *month])
        .join(_unit_rows(units, group_id), "idUF", "left_semi")
    )
    return per_unit.groupBy("mes").agg(
        F.sum("ordinario").alias("ordinario"),
        F.sum("extraordinario").alias("extraordinario"),
        F.sum(F.col("ordinario") + F.col("extraordinario")).alias("total"),
    )


def _ranked(months: DataFrame, kind: str, n: int) -> DataFrame:
    top = months.orderBy(F.desc("total"), F.desc("mes")).limit(n)
    place = Window.orderBy(F.desc("total"), F.desc("mes"))
    return top.select(
        F.lit(kind).alias("tipo"),
        "mes",
        F.col("total").cast("decimal(38,2)").alias("total"),
        F.row_number().over(place).alias("rango"),
    )


def top_income_months(
    payments: DataFrame,
    units: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None = None,
    n: int = 5,
) -> DataFrame:
    """Months with the highest income, within exactly the given days."""
    paid = _paid_per_unit(payments, date_from, date_to, dates.month_start(F.col("fechaPago")), "mes")
    months = (
        paid.join(_unit_rows(units, group_id), "idUF", "left_semi")
        .groupBy("mes")
        .agg(F.sum("monto").alias("total"))
    )
    return _ranked(months, "INGRESOS", n)


def top_expense_months(
    charges: DataFrame,
    details: DataFrame,
    units: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None = None,
    n: int = 5,
) -> DataFrame:
    """Months with the highest charges; the range is widened to whole months."""
    first = dt.date.fromisoformat(str(date_from)).replace(day=1)
    end = dt.date.fromisoformat(str(date_to))
    last = dates.month_bounds(end.year, end.month)[1]
    whole = dates.in_range(charges, "periodo", first, last)
    return _ranked(_charged_per_month(whole, details, units, group_id, "tipo"), "GASTOS", n)


def top_months(
    payments: DataFrame,
    charges: DataFrame,
    details: DataFrame,
    units: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None = None,
    n: int = 5,
) -> DataFrame:
    """Both rankings in one frame, told apart by `tipo`."""
    return top_income_months(payments, units, date_from, date_to, group_id, n).unionByName(
        top_expense_months(charges, details, units, date_from, date_to, group_id, n)
    )


def account_balances(
    units: DataFrame, payments: DataFrame, charges: DataFrame, cutoff: Day, group_id: int | None = None
) -> DataFrame:
    """Per account: its units, what they paid up to the day and were charged up to its month.

    Payments and charges shrink to one row per unit before they meet the units.
    """
    day = F.lit(str(cutoff)).cast("date")
    paid = (
        payments.filter(F.col("nroUnidadFuncional").isNotNull() & (F.col("fechaPago") <= day))
        .groupBy(F.col("nroUnidadFuncional").alias("idUF"))
        .agg(F.sum("monto").alias("_pagos"))
    )
    charged = (
        charges.filter(F.col("periodo") <= F.last_day(day))
        .groupBy("idUF")
        .agg(F.sum("montoTotal").alias("_expen"))
    )
    mapped = _unit_rows(units.filter(F.col("cbu_cvu_actual").isNotNull()), group_id, "cbu_cvu_actual")
    zero = F.lit(0).cast("decimal(28,2)")
    return (
        mapped.join(paid, "idUF", "left")
        .join(charged, "idUF", "left")
        .groupBy(F.col("cbu_cvu_actual").alias("cbu"))
        .agg(
            F.count(F.lit(1)).alias("unidades"),
            F.coalesce(F.sum("_pagos"), zero).cast("decimal(28,2)").alias("pagos"),
            F.coalesce(F.sum("_expen"), zero).cast("decimal(28,2)").alias("expen"),
        )
        .withColumn("deuda", F.col("expen") - F.col("pagos"))
    )


def top_debtors(
    persons: DataFrame,
    units: DataFrame,
    payments: DataFrame,
    charges: DataFrame,
    cutoff: Day,
    group_id: int | None = None,
    n: int = 3,
    one_row_per_person: bool = False,
) -> DataFrame:
    """Tenants with the highest debt.

    A tenant is tied to units by account, so all units of an account share one total, and a
    tenant appears once per unit. Totals are kept per account and a tenant joins one row; the
    repeats are added after the cut, where at most `n` tenants are left.
    """
    owing = account_balances(units, payments, charges, cutoff, group_id).filter("deuda > 0")
    tenants = persons.filter(match_key(F.col("tipoTitularidad")) == TENANT.lower())
    order = [F.desc("deuda"), F.asc("apellido"), F.asc("nombre"), F.asc("dni")]
    first = (
        tenants.join(owing, tenants["cbu_cvu"] == owing["cbu"])
        .select("nombre", "apellido", "dni", "email", "telefono", "pagos", "expen", "deuda", "unidades")
        .orderBy(*order)
        .limit(n)
    )
    if not one_row_per_person:
        # A tenant with many units cannot fill more than n places.
        times = F.least(F.col("unidades"), F.lit(n)).cast("int")
        first = first.withColumn("_vez", F.explode(F.sequence(F.lit(1), times)))
        first = first.drop("_vez").orderBy(*order).limit(n)
    return first.drop("unidades")


def payment_days(payments: DataFrame, date_from: Day, date_to: Day) -> DataFrame:
    """Per unit and day: number of payments, the last payment and the days to the next one."""
    return _days(_paid(payments, date_from, date_to))


def _paid(payments: DataFrame, date_from: Day, date_to: Day) -> DataFrame:
    linked = _linked_payments(payments, date_from, date_to)
    return linked.select("idDePago", F.col("nroUnidadFuncional").alias("idUF"), "fechaPago")


def _days(paid: DataFrame) -> DataFrame:
    """One row per unit and day, so the windows hold at most the days of the range.

    `antes` counts the unit's payments of earlier days.
    """
    days = paid.groupBy("idUF", "fechaPago").agg(
        F.count(F.lit(1)).alias("pagos"), F.min("idDePago").alias("primero"), F.max("idDePago").alias("ultimo")
    )
    by_day = Window.partitionBy("idUF").orderBy("fechaPago")
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)
    return days.select(
        "*",
        F.date_diff(F.lead("fechaPago").over(by_day), F.col("fechaPago")).alias("dias"),
        F.coalesce(F.sum("pagos").over(earlier), F.lit(0)).alias("antes"),
    )


def _named_units(units: DataFrame, groups: DataFrame, group_id: int | None) -> DataFrame:
    named = groups.select(F.col("id").alias("idConsorcio"), F.col("nombre").alias("consorcio"))
    return _unit_rows(units, group_id, "idConsorcio", "numeroUnidad").join(named, "idConsorcio")


def payment_gaps(
    payments: DataFrame,
    units: DataFrame,
    groups: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None = None,
    marks: bool = False,
) -> DataFrame:
    """One row per payment with the days to the unit's next one; NULL after the last.

    Payments of one day are 0 apart except the day's last one. The gap is found per day and
    handed to that last payment over its unique id, so a unit or day with very many payments
    is never sorted in one task. Payments are scanned and dealt by their id once: the days are
    counted over the same exchange. With `marks`, `abre` and `fin` tell the first and the last
    payment of a unit.
    """
    paid = _paid(payments, date_from, date_to).repartition("idDePago")
    opens = F.col("antes") == 0

    def step(payment: str, days: Column, closes: bool, first: Column) -> Column:
        last = F.lit(closes) & F.col("dias").isNull()
        return F.struct(
            F.col(payment).alias("idDePago"),
            days.cast("int").alias("dias"),
            F.lit(closes).alias("_cierra"),
            first.alias("abre"),
            last.alias("fin"),
        )

    alone = F.col("primero") == F.col("ultimo")
    closing = step("ultimo", F.col("dias"), True, opens & alone)
    opening = step("primero", F.lit(None), False, F.lit(True))
    steps = _days(paid).select(F.inline(F.when(opens & ~alone, F.array(opening, closing)).otherwise(F.array(closing))))
    gap = F.when(F.col("_cierra"), F.col("dias")).otherwise(F.lit(0))
    marked = [F.coalesce(c, F.lit(False)).alias(c) for c in ("abre", "fin")] if marks else []
    return (
        paid.join(steps, "idDePago", "left")
        .join(_named_units(units, groups, group_id), "idUF")
        .select(
            "idUF",
            "numeroUnidad",
            "consorcio",
            "idDePago",
            F.col("fechaPago").alias("fecha"),
            gap.alias("dias_hasta_siguiente"),
            *marked,
        )
    )


#: Payments in one array of the nested report.
CHUNK = 1000


def payment_gaps_nested(
    payments: DataFrame,
    units: DataFrame,
    groups: DataFrame,
    date_from: Day,
    date_to: Day,
    group_id: int | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """The payments of each unit in order, as arrays of at most `chunk` with their number.

    A payment's place is its place within the day plus the payments of earlier days, so nothing
    larger than one day of a unit is ever sorted.
    """
    paid = _paid(payments, date_from, date_to).repartition("idUF", "fechaPago")
    in_day = Window.partitionBy("idUF", "fechaPago").orderBy("idDePago")
    placed = paid.withColumn("_n", F.row_number().over(in_day)).join(_days(paid), ["idUF", "fechaPago"])
    gap = F.when(F.col("idDePago") == F.col("ultimo"), F.col("dias")).otherwise(F.lit(0))
    entry = F.struct(F.col("fechaPago").alias("fecha"), "idDePago", gap.alias("dias_hasta_siguiente"))
    blocks = placed.groupBy("idUF", F.floor((F.col("antes") + F.col("_n") - 1) / chunk).alias("bloque")).agg(
        F.sort_array(F.collect_list(entry)).alias("pagos")
    )
    return blocks.join(_named_units(units, groups, group_id), "idUF").select(
        "idUF", "numeroUnidad", "consorcio", "bloque", "pagos"
    )


def payment_gaps_xml(gaps: DataFrame, siblings: bool = True) -> DataFrame:
    """Lines of the payment document from `payment_gaps` with marks, with their order columns."""
    return xml.to_xml_nested(
        gaps,
        opens="abre",
        closes="fin",
        parent_tag="UF",
        child_tag="pago",
        parent_attributes={"idUF": "idUF", "nro": "numeroUnidad", "consorcio": "consorcio"},
        child_attributes={"fecha": "fecha", "dias_hasta_siguiente": "dias_hasta_siguiente"},
        order_parents=["consorcio", "numeroUnidad", "idUF"],
        order_children=["fecha", "idDePago"],
        siblings=siblings,
    )
