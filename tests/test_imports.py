"""Import cases on hand-made rows."""

import datetime as dt
import json
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patio import schemas
from patio.operators import quality, upsert
from patio.plans import imports
from patio.plans.linking import link_payments


def rejected(df):
    return sorted((r.motivo, r.copias) for r in df.collect())


@pytest.fixture
def groups(table):
    return table(
        "consorcio",
        {"id": 1, "nombre": "Robledal", "domicilio": "x", "cantidadUnidades": 2, "m2totales": 100},
        {"id": 2, "nombre": "Tilos", "domicilio": "y", "cantidadUnidades": 1, "m2totales": 50},
    )


@pytest.fixture
def units(table):
    base = {"coeficiente": "1.0"}
    return table(
        "unidad",
        {"idUF": 1, "idConsorcio": 1, "numeroUnidad": 1, "piso": 4, "departamento": "A", "m2_UF": 60, "cbu_cvu_actual": "0001", **base},
        {"idUF": 2, "idConsorcio": 1, "numeroUnidad": 2, "departamento": "B", "m2_UF": 30, "cbu_cvu_actual": "0001", **base},
        {"idUF": 3, "idConsorcio": 2, "numeroUnidad": 1, "m2_UF": 50, **base},
    )


# ------------------------------------------------------------------------------------ payments


def test_payments(raw, table, units):
    rows = raw(
        schemas.RAW_PAYMENTS,
        ("1001", "25/04/2025", " 00 01", " $ 1500.50"),
        ("1002", "5/4/2025", "9999", "10"),
        ("1003", "2025-13-45", "0001", "10"),
        ("1004", "2025-04-25 10:00:00", "0001", "1.234.56"),
        ("1005", "2025-04-25", "  ", "10"),
        ("x", "2025-04-25", "0001", "10"),
        ("1006", "2025-04-25", "0001", "20"),
        ("1006", "2025-04-25", "0001", "10"),
        ("1006", "2025-04-25", "0001", "20"),
        ("1007", "2025-04-25", "0001", "10"),
    )
    known = table("pago", {"idDePago": 1007, "fechaPago": "2025-01-01", "cbu": "1", "monto": 1})
    result = imports.import_payments(rows, units, known)
    got = {r.idDePago: (r.nroUnidadFuncional, r.fechaPago, r.cbu, r.monto) for r in result.payments.collect()}
    assert got == {
        1001: (1, dt.date(2025, 4, 25), "0001", Decimal("1500.50")),
        1002: (None, dt.date(2025, 4, 5), "9999", 10),
        1006: (1, dt.date(2025, 4, 25), "0001", 10),
    }
    assert rejected(result.rejects) == [
        ("clave repetida", 2), ("cuenta", 1), ("fecha", 1), ("id", 1), ("monto", 1),
    ]
    shared = result.shared_accounts.collect()
    assert [(r.cbu, r.idUF, r.unidades) for r in shared] == [("0001", 1, 2)]
    bad = next(r for r in result.rejects.collect() if r.motivo == "monto")
    assert json.loads(bad.fila)["ValorTxt"] == "1.234.56"


def test_payments_twice_adds_nothing(raw, table, units):
    rows = raw(schemas.RAW_PAYMENTS, ("1", "25/04/2025", "0001", "5"), ("2", "25/04/2025", "7", "5"))
    first = imports.import_payments(rows, units, table("pago")).payments
    assert first.count() == 2
    assert imports.import_payments(rows, units, first).payments.count() == 0


def test_linking_moves_only_waiting_payments(table, units):
    payments = table(
        "pago",
        {"idDePago": 1, "nroUnidadFuncional": None, "fechaPago": "2025-01-01", "cbu": "0001", "monto": 1},
        {"idDePago": 2, "nroUnidadFuncional": 3, "fechaPago": "2025-01-01", "cbu": "0001", "monto": 1},
        {"idDePago": 3, "nroUnidadFuncional": None, "fechaPago": "2025-01-01", "cbu": "8", "monto": 1},
    )
    linked = link_payments(payments, units.select("idUF", "cbu_cvu_actual"))
    assert sorted((r.idDePago, r.nroUnidadFuncional) for r in linked.collect()) == [(1, 1), (2, 3), (3, None)]


def test_unreadable_amounts(raw, groups):
    """Text that is no amount is rejected with its row; a missing amount is not."""
    rows = raw(
        schemas.RAW_CHARGES,
        ("Tilos", "mayo", "abc", "1", None, None, None, None, None),
        ("Tilos", "junio", "99999999999,00", None, None, None, None, None, None),
        ("Tilos", "julio", "10,00", " ", None, None, None, None, None),
    )
    amounts, rejects = imports.monthly_amounts(rows, groups, 2025)
    assert [r.periodo.month for r in amounts.collect()] == [7]
    found = rejects.collect()
    assert {r.motivo for r in found} == {imports.UNREADABLE} and '"abc"' in "".join(r.fila for r in found)


def test_target_is_only_scanned(spark):
    """A small source leaves the target's side without an exchange."""
    from patio.operators import upsert

    target = spark.range(0, 2_000_000).select(F.col("id"), F.col("id").cast("string").alias("x"))
    source = spark.createDataFrame([(5, "new"), (2_000_001, "more")], "id long, x string")
    fresh = upsert.new_rows(target, source, ["id"])
    assert [r.id for r in fresh.collect()] == [2_000_001]
    changed = upsert.update_matched(target, source, ["id"])
    assert changed.filter("x = 'new'").count() == 1 and changed.count() == 2_000_000
    changed = changed.filter("x = 'new'")
    for frame in (fresh, changed):
        frame.collect()
        assert above(frame, "Range (0, 2000000", "BroadcastHashJoin") == []


def above(frame, leaf, node):
    """Exchanges between a leaf of the final plan and the first such node above it."""
    lines = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            if node in line:
                return found
            if "Exchange" in line or "QueryStage" in line:
                found.append(line)
    raise AssertionError(f"no {node} above {leaf}")


@pytest.mark.parametrize("most", [0, 1 << 30])
def test_large_and_small_changes_agree(spark, monkeypatch, most):
    """Beyond the limit of a broadcast, a bitmap of the keys cuts the target."""
    from patio.operators import upsert

    monkeypatch.setattr(upsert, "MOST_BYTES", most)
    target = spark.range(0, 5000).select(F.col("id").alias("k"), F.concat(F.lit("N"), F.col("id") % 1000).alias("n"), F.lit(1).alias("v"))
    target = target.unionByName(spark.createDataFrame([(None, None, 9)], "k long, n string, v int"))
    source = spark.createDataFrame([(5, "n5 ", 7), (6000, "n5 ", 8), (None, "x", 2)], "k long, n string, v int")
    assert sorted(r.v for r in upsert.new_rows(target, source, ["k"]).collect()) == [2, 8]
    assert sorted(r.v for r in upsert.new_rows(target, source, ["n"], fold=["n"]).collect()) == [2]
    rows = upsert.update_matched(target, source, ["k"], columns=["v"])
    assert {(r.k, r.v): r["count"] for r in rows.filter("v <> 1").groupBy("k", "v").count().collect()} == {(5, 7): 1, (None, 9): 1}
    assert rows.count() == 5001
    assert upsert.upsert(target, source, ["k"]).count() == 5003


# -------------------------------------------------------------------------------------- groups


def test_groups(raw, groups):
    rows = raw(
        schemas.RAW_GROUPS,
        ("a", " Palmeras ", "Calle 1", "12", "1.281"),
        ("a", "robledal", " Calle 2", "5", "300"),
        ("a", "Mal", "Calle 2", "0", "300"),
        ("a", "Mal2", "Calle 2", "5", "x"),
        ("a", " ", "Calle 2", "5", "3"),
        ("a", "Acacias", "Calle 8", "9", "900"),
        ("a", "ACACIAS", "", "9", "900"),
    )
    result = imports.import_groups(rows, groups)
    got = sorted(tuple(r) for r in result.table.collect())
    assert got == [
        (1, "Robledal", "Calle 2", 5, 300),
        (2, "Tilos", "y", 1, 50),
        (3, "Acacias", "Calle 8", 9, 900),
        (4, "Palmeras", "Calle 1", 12, 1281),
    ]
    assert rejected(result.rejects) == [("domicilio", 1), ("m2", 1), ("nombre", 1), ("unidades", 1)]
    # Keeping one row per name before checking loses the name whose kept row is invalid.
    lost = imports.import_groups(rows, groups, reference_order=True)
    assert "acacias" not in {r.nombre.lower() for r in lost.table.collect()}
    again = imports.import_groups(rows, result.table)
    assert again.inserted.count() == 0 and sorted(tuple(r) for r in again.table.collect()) == got


# ----------------------------------------------------------------------------------- providers


def test_providers(raw, groups, table):
    known = table("prestador", {"id": 9, "idConsorcio": 1, "nombre": "Edesur", "tipoServicio": "Luz", "cuenta": "5"})
    rows = raw(
        schemas.RAW_PROVIDERS,
        ("LUZ ", "edesur", "-", "ROBLEDAL"),
        ("Agua", "Aysa", "Cuenta 0012.345", " Tilos "),
        ("Agua", "aysa ", "Cuenta 0012.345", "Tilos"),
        ("Gas", "Metro", "1" * 22, "Tilos"),
        ("Gas", "Metro", "1", "Nadie"),
        (" ", "Metro", "1", "Tilos"),
    )
    result = imports.import_providers(rows, groups, known)
    got = sorted(tuple(r) for r in result.table.collect())
    assert got == [
        (9, 1, "Edesur", "Luz", None),
        (10, 2, "Aysa", "Agua", "0012345"),
        (11, 2, "Metro", "Gas", None),
    ]
    assert rejected(result.rejects) == [("clave repetida", 1), ("grupo desconocido", 1), ("tipo", 1)]


# ------------------------------------------------------------------------------- unit accounts


def test_unit_accounts(raw, groups, units):
    rows = raw(
        schemas.RAW_UNIT_ACCOUNTS,
        ('"0000 0000-01"', "Robledal", "1", "x", "departamentoX"),
        ("", "ROBLEDAL ", "2", "x", ""),
        ("00x", "Robledal", "2", "x", "Z"),
        ("77", "Robledal", '"1.000"', "x", "C"),
        ("77", "Robledal", "1000", "x", "D"),
        ("77", "Nadie", "1", "x", "D"),
        ("77", "Tilos", "x", "x", "D"),
    )
    result = imports.import_unit_accounts(rows, groups, units)
    got = {r.idUF: (r.idConsorcio, r.numeroUnidad, r.piso, r.departamento, r.coeficiente, r.m2_UF, r.cbu_cvu_actual) for r in result.units.collect()}
    one, none = Decimal("1.0"), Decimal("0.0")
    assert got == {
        1: (1, 1, 4, "departamen", one, 60, "0000000001"),
        2: (1, 2, None, "B", one, 30, "0001"),
        3: (2, 1, None, None, one, 50, None),
        4: (1, 1000, None, "C", none, 1, "77"),
    }
    assert sorted((r.idUF, r.cbu_cvu_actual) for r in result.changed.collect()) == [
        (1, "0000000001"), (2, "0001"), (4, "77"),
    ]
    assert rejected(result.rejects) == [("clave repetida", 1), ("cuenta", 1), ("grupo desconocido", 1), ("unidad", 1)]


# ------------------------------------------------------------------------------------- persons


def test_persons(raw, table):
    known = table("persona", {"id": 5, "nombre": "Old", "apellido": "O", "dni": 20111222, "email": "a@b", "telefono": "1"})
    rows = raw(
        schemas.RAW_PERSONS,
        ("Ana", '"Perez"', "20.111.222", "", "1144445555", "01", "1"),
        ("Luz", "Q", "30111222", "l @x.org", "", "", '"2"'),
        ("Leo", "R", "9999999", "", "", "", "1"),
        ("Leo", "R", "40111222", "", "+54", "", "1"),
        ("Twin", "R", "50111222", "", "", "", "1"),
        ("Twin", "S", "50.111.222", "", "", "", "1"),
        ("", "S", "60111222", "", "", "", "1"),
    )
    result = imports.import_persons(rows, known)
    assert sorted(tuple(r) for r in result.table.collect()) == [
        (5, "Ana", "Perez", 20111222, None, "1144445555", "01", "Inquilino"),
        (6, "Luz", "Q", 30111222, "l@x.org", None, None, "Propietario"),
    ]
    assert rejected(result.rejects) == [
        ("clave repetida", 1), ("clave repetida", 1), ("dni", 1), ("nombre", 1), ("telefono", 1),
    ]


# --------------------------------------------------------------------------------------- units


def test_units(raw, groups, units, table):
    rooms = table("accesoria", {"idUnidadFuncional": 3, "baulera": "true", "cochera": "true", "m2_baulera": 9, "m2_cochera": 9})
    rows = raw(
        schemas.RAW_UNITS,
        ("Robledal", "1", "PB", " ", "", "45", "SI", "NO", "5", "0"),
        ("robledal ", "9", "3", "C", "12,34", "x", None, "si", "", "7"),
        ("Robledal", "8", "3", "C", "100,5", "20", None, None, None, None),
        ("Robledal", "x", "3", "C", "1", "20", None, None, None, None),
        ("Robledal", "7", "3", "C", "1", "0", None, None, None, None),
        ("Robledal", "6", "3", "C", "1", "10", None, None, None, None),
        ("Robledal", "6", "3", "D", "1", "10", None, None, None, None),
        ("Nadie", "6", "3", "D", "1", "10", None, None, None, None),
    )
    result = imports.import_units(rows, groups, units, rooms)
    got = {r.idUF: (r.numeroUnidad, r.piso, r.departamento, r.coeficiente, r.m2_UF, r.cbu_cvu_actual) for r in result.units.collect()}
    # A missing coefficient resets the stored one; floor and apartment stay.
    assert got[1] == (1, 4, "A", Decimal("0.0"), 45, "0001")
    assert got[4] == (8, 3, "C", Decimal("0.0"), 20, None)
    assert got[5] == (9, 3, "C", Decimal("12.3"), 1, None)
    assert len(got) == 5
    state = sorted(tuple(r) for r in result.accessories.collect())
    assert state == [(1, False, True, 5, 0), (3, True, True, 9, 9), (4, False, False, 0, 0), (5, True, False, 0, 7)]
    assert rejected(result.rejects) == [
        ("clave repetida", 1), ("clave repetida", 1), ("grupo desconocido", 1), ("m2", 1), ("unidad", 1),
    ]
    assert {r.idUF for r in result.changed.collect()} == {1, 4, 5}


# ------------------------------------------------------------------------------------- charges


@pytest.fixture
def offers(table, spark):
    providers = table(
        "prestador",
        {"id": 1, "idConsorcio": 1, "nombre": "Banco", "tipoServicio": "banco"},
        {"id": 2, "idConsorcio": 1, "nombre": "Limpia", "tipoServicio": "LIMPIEZA"},
        {"id": 3, "idConsorcio": 1, "nombre": "Limpia 2", "tipoServicio": "limpieza "},
    )
    mapping = spark.createDataFrame(
        [(c, {"BANCARIOS": "Banco", "LIMPIEZA": "Limpieza"}.get(c, "Otro"), "ORDINARIO") for c in schemas.CONCEPTS],
        schemas.CONCEPT_MAP,
    )
    return providers, mapping


def amounts(*values):
    return list(values) + ["0,00"] * (7 - len(values))


def test_charges(raw, groups, units, table, offers):
    providers, mapping = offers
    rooms = table("accesoria", {"idUnidadFuncional": 2, "m2_baulera": 4, "m2_cochera": 6})
    rows = raw(
        schemas.RAW_CHARGES,
        ("Robledal ", "mayo ", *amounts("1,000.01", "200,00", "33,33")),
        ("Tilos", "junio", *amounts("0,00")),
        ("Tilos", "setiembre", *amounts("5,00")),
        (None, None, *[None] * 7),
        ("TILOS", "abril", *amounts("5,00")),
        ("Tilos", "Abril", *amounts("6,00")),
    )
    args = (rows, groups, units, rooms, providers, mapping)
    result = imports.import_charges(*args, table("expensa"), 2025)
    got = {(r.idUF, str(r.periodo)): r.montoTotal for r in result.charges.collect()}
    # 60 and 40 of 100 square metres.
    assert got == {(1, "2025-05-01"): Decimal("740.01"), (2, "2025-05-01"): Decimal("493.33")}
    lines = sorted((r.idExpensa // 100_000, r.idPrestadorServicio, r.importe, r.tipo) for r in result.details.collect())
    # A concept without provider is lost and one with two providers appears twice.
    assert lines == [
        (1, 1, Decimal("600.01"), "Banco"), (1, 2, 120, "Limpieza"), (1, 3, 120, "Limpieza"),
        (2, 1, Decimal("400.00"), "Banco"), (2, 2, 80, "Limpieza"), (2, 3, 80, "Limpieza"),
    ]
    assert rejected(result.rejects) == [
        ("clave repetida", 1), ("clave repetida", 1), ("grupo desconocido", 1), ("mes desconocido", 1),
        ("total no positivo", 1),
    ]
    again = imports.import_charges(*args, result.charges, 2025)
    assert again.charges.count() == again.details.count() == 0

    monthly, _ = imports.monthly_amounts(rows, groups, 2025)
    rest = imports.allocation_residual(monthly.filter("idConsorcio = 1"), units, rooms, providers, mapping).first()
    assert (rest.total, rest.repartido, rest.detallado) == (Decimal("1233.34"), Decimal("1233.34"), Decimal("1400.01"))


def _many_charges(spark, raw, groups, table):
    """Three units, two months, seven providers of one concept; one unit has one month already."""
    units = table("unidad", *[{"idUF": u, "idConsorcio": 1, "numeroUnidad": u, "m2_UF": 30 + u} for u in (1, 2, 3)])
    providers = table("prestador", *[
        {"id": None if p == 7 else p, "idConsorcio": 1, "nombre": f"p{p}", "tipoServicio": "Banco"} for p in range(1, 8)
    ])
    mapping = spark.createDataFrame([(schemas.CONCEPTS[0], "banco ", "ORDINARIO")], schemas.CONCEPT_MAP)
    rows = raw(schemas.RAW_CHARGES, *[("Robledal", m, *amounts("1.000,00")) for m in ("Mayo", "Junio")])
    known = table("expensa", {"id": 1, "idUF": 2, "periodo": "2025-05-01", "montoTotal": 5})
    result = imports.import_charges(rows, groups, units, table("accesoria"), providers, mapping, known, 2025)
    return result, providers, mapping


def test_pairs_and_lines_are_made_last(spark, raw, groups, table):
    details = _many_charges(spark, raw, groups, table)[0].details
    plan = details._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # Lines come from lists above the join with the offers; only units are dealt, not their months.
    made = [line for line in plan if "Join " in line or "Generate " in line]
    assert "explode(_prestadores" in made[0]
    dealt = [line for line in plan if "RepartitionByExpression" in line]
    assert dealt and not any("periodo" in line for line in dealt)


@pytest.mark.parametrize("limit", ["MOST_MONTHS", "MOST_OFFERS", "OFFERS_A_LIST"])
def test_lines_are_the_same_beyond_the_limits(spark, raw, groups, table, monkeypatch, limit):
    monkeypatch.setattr(imports, limit, 2 if limit == "OFFERS_A_LIST" else 0)
    result, providers, mapping = _many_charges(spark, raw, groups, table)
    charged = {(r.idUF, r.periodo.month) for r in result.charges.collect()}
    assert charged == {(1, 5), (3, 5), (1, 6), (2, 6), (3, 6)}
    got = Counter((r.idExpensa, r.idPrestadorServicio, r.importe, r.tipo, r.categoria) for r in result.details.collect())
    # Of 96 square metres.
    share = {1: Decimal("322.92"), 2: Decimal("333.33"), 3: Decimal("343.75")}
    assert got == Counter(
        (u * 100_000 + 2025 * 12 + m - 1, p, share[u], "banco ", "ORDINARIO")
        for u, m in charged for p in (1, 2, 3, 4, 5, 6, None)
    )
    lists = imports.offer_lists(providers, mapping)
    assert lists.count() > 1 if limit == "OFFERS_A_LIST" else lists.count() == 1


def test_tasks_follow_the_lines(spark, raw, groups, table, monkeypatch):
    """Three units, two months and seven providers are 6 pairs with 7 lines each."""

    def dealt_to(result):
        plan = result.details._jdf.queryExecution().optimizedPlan().toString()
        return [int(n) for n in re.findall(r"RepartitionByExpression \[idUF.*\], (\d+)", plan)]

    few = _many_charges(spark, raw, groups, table)[0]
    monkeypatch.setattr(imports, "LINES_A_TASK", 5, raising=False)
    many = _many_charges(spark, raw, groups, table)[0]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt_to(few) == [tasks] and dealt_to(many)[0] > tasks
    work = 3 * 2 * (7 + imports.LINES_A_PAIR)
    assert dealt_to(many) == [tasks * -(-work // (5 * tasks))]
    lines = [Counter(tuple(r) for r in result.details.collect()) for result in (few, many)]
    assert lines[0] == lines[1] and lines[0].total() == 35


def test_shares_stay_near_the_building_total(spark, table, offers):
    providers, mapping = offers
    n = 61
    many = spark.range(1, n + 1).select(
        F.col("id").alias("idUF"), F.lit(1).cast("bigint").alias("idConsorcio"), F.col("id").alias("numeroUnidad"),
        (F.col("id") * 7 % 53 + 11).cast("int").alias("m2_UF"),
    )
    one = spark.createDataFrame([(1, dt.date(2025, 4, 1))], "idConsorcio bigint, periodo date").select(
        "*", *[F.lit(Decimal(f"{1000 * i}.37")).cast("decimal(12,2)").alias(c) for i, c in enumerate(schemas.CONCEPTS, 1)]
    )
    rest = imports.allocation_residual(one, many, table("accesoria"), providers, mapping).first()
    assert abs(rest.resto_reparto) <= Decimal("0.005") * 7 * n


def test_group_without_area(raw, groups, table, offers):
    providers, mapping = offers
    flat = table("unidad", {"idUF": 1, "idConsorcio": 1, "numeroUnidad": 1, "m2_UF": 0})
    rows = raw(schemas.RAW_CHARGES, ("Robledal", "mayo", *amounts("10,00")))
    result = imports.import_charges(rows, groups, flat, table("accesoria"), providers, mapping, table("expensa"), 2025)
    assert result.charges.count() == 0
    assert rejected(result.rejects) == [("total no positivo", 1)]


# ------------------------------------------------------------------------------------- quality


def test_rules(groups, units, table):
    found = quality.summary({"consorcio": groups, "unidad": units, "pago": table(
        "pago",
        {"idDePago": 1, "nroUnidadFuncional": 77, "fechaPago": "2025-01-01", "cbu": "1", "monto": 1},
        {"idDePago": 1, "nroUnidadFuncional": None, "fechaPago": "2025-01-01", "cbu": "1", "monto": 1},
    )})
    broken = {(r.tabla, r.regla): r.violaciones for r in found.collect() if r.violaciones}
    assert broken == {("pago", "unique idDePago"): 1, ("pago", "nroUnidadFuncional -> unidad"): 1}
    assert quality.broken_checks(table("unidad", {"idUF": 1, "m2_UF": 0, "coeficiente": 1}), "unidad").first().motivo == "m2_UF > 0"


def test_merge_source_must_be_unique(units):
    with pytest.raises(upsert.RepeatedKeyError, match="idConsorcio"):
        upsert.assert_unique(units, ["idConsorcio"])
    assert upsert.assert_unique(units, ["idUF"]) is units
