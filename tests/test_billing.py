"""Billing cases, month by month and all at once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from patio.functions.keys import charge_id
from patio.operators import joins
from patio.plans import billing


def charge(unit, period, amount):
    return {"id": unit * 100_000 + int(period[:4]) * 12 + int(period[5:7]) - 1, "idUF": unit, "periodo": period, "montoTotal": amount}


@pytest.fixture
def charges(table):
    return table(
        "expensa",
        charge(1, "2025-04-01", 100), charge(1, "2025-05-01", 50), charge(1, "2025-06-01", 10),
        charge(2, "2025-04-01", 80), charge(2, "2025-06-01", 20),
    )


@pytest.fixture
def payments(table):
    def pay(i, unit, day, amount):
        return {"idDePago": i, "nroUnidadFuncional": unit, "fechaPago": day, "cbu": "1", "monto": amount}

    return table(
        "pago",
        pay(1, 1, "2025-04-30", 130), pay(2, 1, "2025-05-01", 5), pay(3, None, "2025-05-02", 999),
        pay(4, 2, "2025-05-10", 7), pay(5, 2, "2025-06-30", 1), pay(6, 2, "2025-06-01", 2),
    )


def test_months_in_order_equal_the_history(charges, payments, table):
    details = table(
        "detalle",
        {"idExpensa": charge(1, "2025-04-01", 0)["id"], "importe": 60, "categoria": "EXTRAORDINARIO"},
        {"idExpensa": charge(1, "2025-04-01", 0)["id"], "importe": 40, "categoria": None},
    )
    holidays = table("feriado", {"fecha": "2025-05-25"})
    invoices, statements = table("factura"), table("estado")
    sent = {}
    for month, issued in ((4, "2025-04-25"), (5, "2025-05-25"), (6, "2025-06-25")):
        args = (charges, details, payments, invoices, statements, holidays, 2025, month, issued)
        bill = billing.bill_month(*args)
        invoices = invoices.unionByName(bill.invoices)
        statements = statements.unionByName(bill.statements)
        sent.update({r.id: str(r.fechaEnvio) for r in bill.charges.collect()})
    got = sorted(tuple(r) for r in statements.collect())
    assert got == sorted(tuple(r) for r in billing.bill_history(charges, payments).collect())
    balances = {(r.idUF, str(r.periodo)): (r.saldoAnterior, r.saldoNuevo, r.saldoDeudor, r.saldoAdelantado) for r in statements.collect()}
    assert balances[(1, "2025-04-01")] == (0, -30, 0, 30)
    assert balances[(1, "2025-05-01")] == (-30, 15, 15, 0)
    # Unit 2 has no charge in May, so its payment of May counts nowhere.
    assert balances[(2, "2025-06-01")] == (80, 97, 97, 0)
    lines = {r.idExpensa: (r.totalGastoOrdinario, r.totalGastoExtraordinario, r.fechaVencimiento) for r in invoices.collect()}
    assert lines[charge(1, "2025-04-01", 0)["id"]] == (40, 60, dt.date(2025, 5, 5))
    assert lines[charge(2, "2025-04-01", 0)["id"]] == (None, 0, dt.date(2025, 5, 5))
    assert sent[charge(1, "2025-05-01", 0)["id"]] == "2025-05-26"
    assert sent[charge(2, "2025-06-01", 0)["id"]] == "2025-06-25"
    again = billing.bill_month(charges, details, payments, invoices, statements, holidays, 2025, 5, "2025-05-25")
    assert again.invoices.count() == again.statements.count() == 0
    assert again.charges.count() == 1


def test_eleven_holidays_leave_no_send_date(charges, table):
    days = table("feriado", *[{"fecha": f"2025-05-{d:02d}"} for d in range(10, 21)])
    sent = billing.with_send_date(charges, days, "2025-05-10")
    assert {r.fechaEnvio for r in sent.collect()} == {None}
    ten = billing.with_send_date(charges, days.filter("fecha < '2025-05-20'"), "2025-05-10")
    assert {str(r.fechaEnvio) for r in ten.collect()} == {"2025-05-20"}
    weekend = billing.with_send_date(charges, table("feriado"), "2025-05-10", skip_weekends=True)
    assert {str(r.fechaEnvio) for r in weekend.collect()} == {"2025-05-12"}


def test_asof_is_strict_and_takes_the_latest(spark):
    left = spark.createDataFrame([(1, 5), (1, 5), (1, 1), (2, 9), (3, 4)], "k int, t int")
    right = spark.createDataFrame([(1, 1, "a"), (1, 4, "b"), (1, 5, "c"), (2, 3, None), (2, 1, "z")], "k int, t int, v string")
    got = sorted((r.k, r.t, r.prev_v) for r in joins.asof_before(left, right, "k", "t", ["v"]).collect())
    assert sorted(got, key=str) == sorted([(1, 1, None), (1, 5, "b"), (1, 5, "b"), (2, 9, None), (3, 4, None)], key=str)


def test_history_of_a_long_unit(spark):
    """One unit with most payments: balances equal a plain running sum."""
    payments = spark.range(5000).select(
        F.col("id").alias("idDePago"),
        F.when(F.col("id") % 10 == 0, 2).otherwise(1).cast("bigint").alias("nroUnidadFuncional"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("fechaPago"),
        (F.col("id") % 13).cast("decimal(18,2)").alias("monto"),
    )
    months = spark.range(24).select(F.add_months(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("periodo"))
    charges = months.select(F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("idUF"), "periodo").select(
        charge_id(F.col("idUF"), F.col("periodo")).alias("id"), "idUF", "periodo", F.lit(500).cast("decimal(18,2)").alias("montoTotal")
    )
    got = {(r.idUF, r.periodo): r.saldoNuevo for r in billing.bill_history(charges, payments).collect()}
    rows = payments.collect()
    for unit in (1, 2):
        balance = 0
        for period in sorted(p for u, p in got if u == unit):
            paid = sum(r.monto for r in rows if r.nroUnidadFuncional == unit and r.fechaPago.replace(day=1) == period)
            balance += 500 - paid
            assert got[(unit, period)] == balance


def test_asof_of_one_key_lies_in_many_buckets(spark):
    """A key with most points is cut by month and still finds rows of earlier months."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.hash("id") % 900 + 900).cast("int"))
    key = F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(1))
    left = spark.range(600).select(key.alias("k"), day.alias("t"))
    right = spark.range(700, 740).select(key.alias("k"), day.alias("t"), F.col("id").alias("v"))
    found = joins.asof_before(left, right, "k", "t", ["v"])
    steps = {}
    for r in right.collect():
        steps[(r.k, r.t)] = max(r.v, steps.get((r.k, r.t), 0))
    want = []
    for r in left.collect():
        earlier = [(t, v) for (k, t), v in steps.items() if k == r.k and t < r.t]
        want.append((r.k, r.t, max(earlier)[1] if earlier else None))
    key_of = lambda x: (x[0], x[1], x[2] or 0)
    assert sorted(map(tuple, found.collect()), key=key_of) == sorted(want, key=key_of)
    windows = [w for w in found._jdf.queryExecution().toString().splitlines() if "Window [last" in w and "_side" in w]
    assert windows and all("_lapso" in w for w in windows)
    weekly = joins.asof_before(left, right, "k", "t", ["v"], bucket=F.trunc("t", "week"))
    assert sorted(map(tuple, weekly.collect()), key=key_of) == sorted(want, key=key_of)
