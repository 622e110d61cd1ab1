"""Report cases on hand-made tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patio.plans import profile, reports
from patio.sources import xml

D = dt.date


@pytest.fixture
def small(table):
    groups = table("consorcio", {"id": 1, "nombre": "Uno"}, {"id": 2, "nombre": "Dos"})
    units = table(
        "unidad",
        {"idUF": 1, "idConsorcio": 1, "numeroUnidad": 1, "departamento": "A", "m2_UF": 10, "cbu_cvu_actual": "11"},
        {"idUF": 2, "idConsorcio": 1, "numeroUnidad": 2, "departamento": None, "m2_UF": 10, "cbu_cvu_actual": "11"},
        {"idUF": 3, "idConsorcio": 2, "numeroUnidad": 1, "departamento": "A", "m2_UF": 10, "cbu_cvu_actual": "33"},
    )
    return groups, units


def pay(i, unit, day, amount=100):
    return {"idDePago": i, "nroUnidadFuncional": unit, "fechaPago": day, "cbu": "1", "monto": amount}


def test_weeks(small, table):
    _, units = small
    payments = table(
        "pago",
        pay(1, 1, "2025-04-06"),
        pay(2, 1, "2025-04-05", 50),
        pay(3, 3, "2025-04-30", 70),
        pay(4, None, "2025-04-10", 999),
        pay(5, 1, "2025-05-01", 999),
    )
    rows = reports.weekly_cashflow(payments, units, "2025-04-01", "2025-04-30").collect()
    assert [(r.semana_ini, r.semana_fin, r.total_semana, r.acumulado) for r in rows] == [
        (D(2025, 3, 31), D(2025, 4, 6), 50, 50),
        (D(2025, 4, 7), D(2025, 4, 13), 100, 150),
        (D(2025, 4, 28), D(2025, 5, 4), 70, 220),
    ]
    assert {round(r.promedio_periodo, 2) for r in rows} == {Decimal("73.33")}
    only = reports.weekly_cashflow(payments, units, "2025-04-01", "2025-04-30", group_id=2).collect()
    assert [r.total_semana for r in only] == [70]


def test_pivot_and_xml(small, table):
    groups, units = small
    payments = table("pago", pay(1, 1, "2025-04-06"), pay(2, 2, "2025-06-05", 50), pay(3, 3, "2025-04-30", 70))
    wide = reports.month_by_apartment(payments, units, groups, "2025-01-01", "2025-12-31")
    assert wide.columns == ["consorcio", "departamento", "m_2025_04", "m_2025_06"]
    assert [tuple(r) for r in wide.collect()] == [("Dos", "A", 70, 0), ("Uno", None, 0, 50), ("Uno", "A", 100, 0)]
    lines = [r.xml for r in reports.month_by_apartment_xml(wide).collect()]
    assert '<row consorcio="Uno" m_2025_04="0.00" m_2025_06="50.00"/>' in lines
    empty = reports.month_by_apartment(payments, units, groups, "2020-01-01", "2020-12-31")
    assert empty.columns == ["consorcio", "departamento"] and empty.count() == 0


def test_groups_of_one_name_merge(small, table):
    _, units = small
    groups = table("consorcio", {"id": 1, "nombre": "Uno"}, {"id": 2, "nombre": "UNO "})
    payments = table("pago", pay(1, 1, "2025-04-06"), pay(3, 3, "2025-04-30", 70))
    rows = reports.month_by_apartment(payments, units, groups, "2025-01-01", "2025-12-31").collect()
    assert [(r.departamento, r.m_2025_04) for r in rows] == [("A", 170)]


@pytest.fixture
def charged(table):
    charges = table(
        "expensa",
        {"id": 1, "idUF": 1, "periodo": "2025-04-01", "montoTotal": 500},
        {"id": 2, "idUF": 3, "periodo": "2025-05-01", "montoTotal": 300},
    )
    details = table(
        "detalle",
        {"idExpensa": 1, "importe": 100, "tipo": "Extraordinario"},
        {"idExpensa": 1, "importe": 40, "tipo": None},
        {"idExpensa": 1, "importe": 7, "tipo": "EXTRAORDINARIO "},
        {"idExpensa": 2, "importe": 147, "tipo": "otro"},
    )
    return charges, details


def test_origin(small, charged):
    _, units = small
    charges, details = charged
    rows = reports.by_origin(charges, details, units, "2025-04-01", "2025-12-31").collect()
    assert [tuple(r) for r in rows] == [(D(2025, 4, 1), 40, 107, 147), (D(2025, 5, 1), 147, 0, 147)]
    # A range that starts inside a month leaves that month out.
    rows = reports.by_origin(charges, details, units, "2025-04-02", "2025-12-31").collect()
    assert [r.periodo for r in rows] == [D(2025, 5, 1)]


def test_top_months_widen_only_the_charges(small, charged, table):
    _, units = small
    payments = table("pago", pay(1, 1, "2025-04-06"), pay(2, 1, "2025-04-20", 30), pay(3, 3, "2025-05-10", 30))
    rows = reports.top_months(payments, *charged, units, "2025-04-10", "2025-05-10").collect()
    got = [(r.tipo, r.mes, r.total, r.rango) for r in rows]
    # Equal totals: the later month comes first.
    assert got == [
        ("INGRESOS", D(2025, 5, 1), 30, 1),
        ("INGRESOS", D(2025, 4, 1), 30, 2),
        ("GASTOS", D(2025, 5, 1), 147, 1),
        ("GASTOS", D(2025, 4, 1), 147, 2),
    ]


def test_debtors(small, charged, table):
    _, units = small
    charges, _ = charged
    persons = table(
        "persona",
        {"id": 1, "nombre": "Ana", "apellido": "P", "dni": 1, "cbu_cvu": "11", "tipoTitularidad": "Inquilino"},
        {"id": 2, "nombre": "Luz", "apellido": "Q", "dni": 2, "cbu_cvu": "33", "tipoTitularidad": "Inquilino"},
        {"id": 3, "nombre": "Leo", "apellido": "R", "dni": 3, "cbu_cvu": "33", "tipoTitularidad": "Propietario"},
    )
    payments = table("pago", pay(1, 1, "2025-04-06"), pay(2, 2, "2025-04-11", 30))
    args = (persons, units, payments, charges)
    rows = reports.top_debtors(*args, "2025-04-10").collect()
    # Two units of one account: two rows with the same total; April's charge counts in full.
    assert [(r.nombre, r.pagos, r.expen, r.deuda) for r in rows] == [("Ana", 100, 500, 400)] * 2
    rows = reports.top_debtors(*args, "2025-05-31", n=2).collect()
    assert [(r.nombre, r.deuda) for r in rows] == [("Ana", 370), ("Ana", 370)]
    rows = reports.top_debtors(*args, "2025-05-31", one_row_per_person=True).collect()
    assert [(r.nombre, r.deuda) for r in rows] == [("Ana", 370), ("Luz", 300)]
    rows = reports.top_debtors(*args, "2025-05-31", group_id=2).collect()
    assert [r.nombre for r in rows] == ["Luz"]


def test_gaps(small, table, spark, tmp_path):
    groups, units = small
    payments = table(
        "pago",
        pay(1, 1, "2025-04-06"),
        pay(2, 1, "2025-04-06"),
        pay(3, 1, "2025-04-06"),
        pay(4, 1, "2025-04-30"),
        pay(5, 1, "2025-05-02"),
        pay(6, 3, "2025-04-01"),
        pay(7, None, "2025-04-01"),
    )
    gaps = reports.payment_gaps(payments, units, groups, "2025-04-01", "2025-04-30")
    got = {r.idDePago: r.dias_hasta_siguiente for r in gaps.collect()}
    assert got == {1: 0, 2: 0, 3: 24, 4: None, 6: None}
    args = (payments, units, groups, "2025-04-01", "2025-04-30")
    nested = {(r.idUF, r.bloque): [tuple(x) for x in r.pagos] for r in reports.payment_gaps_nested(*args, chunk=2).collect()}
    first, last = D(2025, 4, 6), D(2025, 4, 30)
    assert nested == {
        (1, 0): [(first, 1, 0), (first, 2, 0)], (1, 1): [(first, 3, 24), (last, 4, None)], (3, 0): [(D(2025, 4, 1), 6, None)],
    }

    marked = reports.payment_gaps(*args, marks=True)
    assert [r.idDePago for r in marked.filter("abre").orderBy("idDePago").collect()] == [1, 6]
    assert [r.idDePago for r in marked.filter("fin").orderBy("idDePago").collect()] == [4, 6]
    lines = xml.in_document_order(reports.payment_gaps_xml(marked, siblings=False))
    body = [r.xml for r in lines.collect()]
    assert body == [
        '<UF idUF="3" nro="1" consorcio="Dos">', '<pago fecha="2025-04-01"/>', "</UF>",
        '<UF idUF="1" nro="1" consorcio="Uno">',
        '<pago fecha="2025-04-06" dias_hasta_siguiente="0"/>',
        '<pago fecha="2025-04-06" dias_hasta_siguiente="0"/>',
        '<pago fecha="2025-04-06" dias_hasta_siguiente="24"/>',
        '<pago fecha="2025-04-30"/>',
        "</UF>",
    ]
    flat = [r.xml for r in xml.in_document_order(reports.payment_gaps_xml(marked)).collect()]
    assert flat[0] == '<UF idUF="3" nro="1" consorcio="Dos"/>' and len(flat) == 7

    xml.write_xml(lines, str(tmp_path / "doc"), reports.ROOT_PAYMENTS)
    files = sorted((tmp_path / "doc").glob("part-*"))
    text = "".join(f.read_text() for f in files)
    assert text.split("\n")[:-1] == ["<PagosUF>", *body, "</PagosUF>"]
    parsed = spark.read.format("xml").option("rowTag", "UF").load(str(tmp_path / "doc"))
    assert parsed.count() >= 1


def test_payment_document_scans_payments_once(small, spark, tmp_path):
    """Children, openings and closings come from one scan, also those of the days' gaps."""
    groups, units = small
    spark.range(40).selectExpr(
        "id AS idDePago", "id % 3 + 1 AS nroUnidadFuncional", "date_add(DATE'2025-04-01', cast(id % 5 AS int)) AS fechaPago",
        "'1' AS cbu", "cast(1 AS decimal(18,2)) AS monto",
    ).write.parquet(str(tmp_path / "pago"))
    payments = spark.read.parquet(str(tmp_path / "pago"))
    for siblings, lines in ((True, 43), (False, 46)):
        marked = reports.payment_gaps(payments, units, groups, "2025-04-01", "2025-04-30", marks=True)
        document = xml.in_document_order(reports.payment_gaps_xml(marked, siblings))
        assert len(document.collect()) == lines
        final = document._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        reused = final.count("ReusedExchange")
        assert final.count("FileScan parquet") - reused <= 1 and reused >= 1, final


def test_empty_document(spark, tmp_path):
    none = spark.createDataFrame([], "xml string")
    xml.write_xml(none, str(tmp_path / "doc"), reports.ROOT_MONTHS)
    text = "".join(f.read_text() for f in sorted((tmp_path / "doc").glob("part-*")))
    assert text == f"<{reports.ROOT_MONTHS}>\n</{reports.ROOT_MONTHS}>\n"


def test_one_unit_with_most_payments(small, spark):
    """A unit with nearly all rows gives the same gaps as sorting its payments one by one."""
    groups, units = small
    n = 3000
    rows = spark.range(n).select(
        F.col("id").alias("idDePago"),
        F.when(F.col("id") % 50 == 0, 3).otherwise(1).cast("bigint").alias("nroUnidadFuncional"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.hash("id") % 20 + 20).cast("int")).alias("fechaPago"),
        F.lit("1").alias("cbu"),
        F.lit(1).cast("decimal(18,2)").alias("monto"),
    )
    got = {r.idDePago: r.dias_hasta_siguiente for r in reports.payment_gaps(rows, units, groups, "2024-01-01", "2025-12-31").collect()}
    want = {}
    for unit in (1, 3):
        mine = sorted((r.fechaPago, r.idDePago) for r in rows.collect() if r.nroUnidadFuncional == unit)
        for (day, i), nxt in zip(mine, [*mine[1:], None]):
            want[i] = (nxt[0] - day).days if nxt else None
    assert got == want


def test_profiles(small, table):
    groups, units = small
    rooms = table(
        "accesoria",
        {"idUnidadFuncional": 1, "baulera": "true", "cochera": "false", "m2_baulera": 1, "m2_cochera": 0},
        {"idUnidadFuncional": 1, "baulera": "false", "cochera": None, "m2_baulera": 1, "m2_cochera": 0},
    )
    found = profile.building_profile(groups, units, rooms)
    assert [tuple(r) for r in profile.storage_only(found).collect()] == [(1, "Uno", 2, 1, 0)]
    assert [tuple(r) for r in profile.with_none(found).collect()] == [(2, "Dos", 1, 0)]
    assert profile.with_both(found).count() == profile.parking_only(found).count() == 0
