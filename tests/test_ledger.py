"""The whole sequence: import in order, bill three months, report, import again."""

from decimal import Decimal

import pytest

from patio import schemas
from patio.functions import privacy
from patio.functions.privacy import WrongKeyError
from patio.ledger import Ledger
from patio.plans import profile

JSON = """[
{"Nombre del consorcio": "Norte", "Mes": "abril", "BANCARIOS": "1,000.00", "LIMPIEZA": "500,00", "SEGUROS": "100.00"},
{"Nombre del consorcio": "Norte", "Mes": "mayo ", "BANCARIOS": "1.000,00", "LIMPIEZA": "2,000,00"},
{"Nombre del consorcio": "Sur", "Mes": "Junio", "LIMPIEZA": "80,40"},
{"_id": {"x": "1"}}]"""


@pytest.fixture
def files(tmp_path):
    def write(name, *lines, end="\r\n"):
        path = tmp_path / name
        path.write_bytes((end.join(lines) + end).encode())
        return str(path)

    return {
        "groups": write("g.csv", "a,nombre,domicilio,unidades,m2", "1,Norte ,Calle 1,3,1.000", "2,Sur,Calle 2,1,200", "3,,x,1,1"),
        "providers": write("p.csv", "1,,t,,,", "2,,h,h,h,h", "3,,Bancos,Banco,Cuenta 12,Norte", "4,,Aseo,Limpia,-,Norte", "5,,Aseo,Limpia,7,sur"),
        "units": write(
            "u.txt",
            "\t".join(schemas.RAW_UNITS),
            "\t".join(["Norte", "1", "PB", "A", "30,0", "60", "SI", "NO", "10", "0"]),
            "\t".join(["Norte", "2", "1", "B", "30,0", "20", "NO", "SI", "0", "10"]),
            "\t".join(["Sur", "1", "1", "A", "99,9", "50", "NO", "NO", "", ""]),
        ),
        "accounts": write("a.csv", "cbu|g|n|t|d", '"0001"|Norte|1|x|A', "0002|Norte|2|x|B", end="\n"),
        "late": write("late.csv", "cbu|g|n|t|d", "0003|Sur|1|x|"),
        "persons": write("per.csv", "n;a;d;e;t;c;i", "Ana;Paz;20.111.222;ana@x.org;11;0001;1", "Luz;Rey;30111222;;;0003;1"),
        "payments": write(
            "pay.csv", "id,f,c,v", "1,10/04/2025,0001,$ 100.00", "2,2025-05-11,0002,50", "3,20/06/2025,0003, $ 80.40", "x,1,1,1"
        ),
        "charges": write("c.json", JSON),
        "holidays": write("h.csv", "fecha,tipo,nombre", "2025-05-25,i,Mayo", "2024-05-25,i,Mayo"),
    }


def test_whole_sequence(spark, tmp_path, files):
    key = "0123456789abcdef"
    book = Ledger(spark, str(tmp_path / "tables"), key)
    concepts = spark.createDataFrame(
        [(c, {"BANCARIOS": "bancos", "LIMPIEZA": "aseo"}.get(c, "otro"), "EXTRAORDINARIO" if c == "LIMPIEZA" else "ORDINARIO") for c in schemas.CONCEPTS],
        schemas.CONCEPT_MAP,
    )

    def load():
        rejects = [
            book.import_groups(files["groups"]),
            book.import_providers(files["providers"]),
            book.import_units(files["units"]),
            book.import_unit_accounts(files["accounts"]),
            book.import_persons(files["persons"]),
            book.import_charges(files["charges"], concepts, 2025),
            book.import_payments(files["payments"]),
        ]
        return [r.count() for r in rejects], {r.tabla: r.filas for r in book.counts().collect()}

    rejected, counts = load()
    assert rejected == [1, 0, 0, 0, 0, 1, 1]
    assert counts == {
        "consorcio": 2, "prestador": 3, "unidad": 3, "accesoria": 3, "persona": 2, "expensa": 5, "detalle": 9, "pago": 3,
    }
    assert book.table("pago").filter("nroUnidadFuncional IS NULL").count() == 1
    book.import_unit_accounts(files["late"])
    assert book.table("pago").filter("nroUnidadFuncional IS NULL").count() == 0
    # Everything once more changes nothing.
    assert load()[1] == counts

    book.load_holidays(files["holidays"], 2025)
    assert book.is_holiday("2025-05-25") and not book.is_holiday("2025-05-26") and not book.is_holiday("2024-05-25")
    book.reset_billing()
    for month, day in ((4, "2025-04-25"), (5, "2025-05-25"), (6, "2025-06-25"), (5, "2025-05-25")):
        book.bill_month(2025, month, day)
    assert book.table("factura").count() == book.table("estado").count() == book.table("expensa").count() == 5
    sent = {str(r.periodo): str(r.fechaEnvio) for r in book.table("expensa").collect()}
    assert sent == {"2025-04-01": "2025-04-25", "2025-05-01": "2025-05-26", "2025-06-01": "2025-06-25"}

    units = {(r.idConsorcio, r.numeroUnidad): r.idUF for r in book.table("unidad").collect()}
    one = units[(1, 1)]
    balances = {(r.idUF, r.periodo.month): r.saldoTotal for r in book.table("estado").collect()}
    # 70 of 100 square metres: 1120 in April less 100 paid, then 2100 more.
    assert balances[(one, 4)] == Decimal("1020.00") and balances[(one, 5)] == Decimal("3120.00")

    year = ("2025-01-01", "2025-12-31")
    assert [r.total_semana for r in book.weekly_cashflow(*year).collect()] == [100, 50, Decimal("80.40")]
    assert book.month_by_apartment(*year).columns[2:] == ["m_2025_04", "m_2025_05", "m_2025_06"]
    origin = {r.periodo.month: (r.Ordinario, r.Extraordinario) for r in book.by_origin(*year).collect()}
    # The origin report reads the service type, so nothing counts as extraordinary.
    assert origin == {4: (1500, 0), 5: (3000, 0), 6: (Decimal("80.40"), 0)}
    assert book.top_months(*year).count() == 6
    # One month of the report reads one month of lines.
    plan = book.by_origin("2025-04-01", "2025-04-30")._jdf.queryExecution().executedPlan().toString()
    scans = [line.split("PartitionFilters")[1].split("]")[0] for line in plan.splitlines() if "FileScan" in line and "periodo_mes" in line]
    assert len(scans) >= 2 and all("2025-04-01" in s or "dynamicpruning" in s for s in scans), scans
    assert [(r.nombre, r.deuda) for r in book.top_debtors("2025-06-30").collect()] == [("Ana", Decimal("3120.00"))]
    assert book.payment_gaps(*year).count() == 3
    assert profile.with_both(book.building_profile()).count() == 1
    book.month_by_apartment_xml(str(tmp_path / "r2"), *year)
    book.payment_gaps_xml(str(tmp_path / "r6"), *year)
    assert book.rule_violations().filter("violaciones > 0").count() == 0
    other = Ledger(spark, str(tmp_path / "tables"), "fedcba9876543210")
    assert [r.nombre for r in other.top_debtors("2025-06-30").collect()] == [None]
    with pytest.raises(WrongKeyError):
        other.import_persons(files["persons"])
    assert [r.nombre for r in book.top_debtors("2025-06-30").collect()] == ["Ana"]
    # Rejects stay with the tables, each once however often a file comes.
    assert {r.origen: r["count"] for r in book.table("rechazo").groupBy("origen").count().collect()} == {
        "consorcio": 1, "expensa": 1, "pago": 1,
    }
    assert book.store.load("persona").count() == 0
    plain = Ledger(spark, str(tmp_path / "tables"))
    plain.import_persons(files["persons"])
    assert [r.nombre for r in plain.top_debtors("2025-06-30").collect()] == ["Ana"]


def test_two_writers(spark, tmp_path, files):
    """An import that read its tables before another one published fails and changes nothing."""
    one, two = (Ledger(spark, str(tmp_path / "tables")) for _ in range(2))
    one.import_groups(files["groups"])
    one.import_units(files["units"])
    one.store.begin()
    stale = one.store.load("unidad")
    two.import_payments(files["payments"])
    with pytest.raises(RuntimeError):
        one.store.publish(replace={"unidad": stale})
    assert two.table("pago").count() == 3
    assert one.import_payments(files["payments"]).count() == 1 and one.table("pago").count() == 3


def test_no_key_in_plans(spark):
    key = "0123456789abcdef"
    privacy.hide_keys(spark)
    people = spark.createDataFrame([("a", "b", "c", "d")], list(privacy.PERSONAL))
    sealed = privacy.encrypt_columns(people, key)
    for frame in (sealed, privacy.decrypt_columns(sealed, key)):
        for mode in ("extended", "formatted"):
            text = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), mode)
            assert key not in text and key.encode().hex().upper() not in text.upper()
