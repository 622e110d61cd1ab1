"""Readers, stored tables, streams and encrypted columns."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from patio import schemas
from patio.functions import dates, privacy
from patio.operators import dedup, identity
from patio.plans.linking import newly_linked
from patio.sources import delimited, holidays, sheets
from patio.sources.charges_json import array_records, read_charges
from patio.sources.tables import TableStore
from patio.streaming import jobs


@pytest.mark.parametrize("ending", ["\r\n", "\n"])
def test_pipe_file_reads_alike_with_both_line_ends(spark, tmp_path, ending):
    path = tmp_path / "u.csv"
    lines = ["cbu|grupo|nro|tipo|depto", '"0000 0000-01"|Robledal|1|x|A', "|Tilos|2||Ñ", "5|corta"]
    path.write_bytes((ending.join(lines) + ending).encode())
    rows = delimited.read_raw(spark, "unit_accounts", str(path)).collect()
    assert [tuple(r) for r in rows] == [
        ('"0000 0000-01"', "Robledal", "1", "x", "A"),
        (None, "Tilos", "2", None, "Ñ"),
        ("5", "corta", None, None, None),
    ]


def test_tab_file_keeps_blanks(spark, tmp_path):
    path = tmp_path / "u.txt"
    path.write_bytes(("\t".join("abcdefghij") + "\r\n" + "\t".join([" Robledal ", "1", "PB", "A", "4,2", "45", "SI", "NO", "5", "0"]) + "\r\n").encode())
    row = delimited.read_raw(spark, "units", str(path)).first()
    assert row[0] == " Robledal " and row[9] == "0"


def test_json_array_ignores_unknown_keys(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(
        '[{"_id": {"x": "1"}, "Nombre del consorcio": "Uno", "Mes": "mayo ", "BANCARIOS": "31,905.20",'
        ' "SERVICIOS PUBLICOS-Luz": "612.380,47"}, {"_id": {"x": "2"}}]'
    )
    rows = read_charges(spark, str(path)).collect()
    assert rows[0]["Nombre del consorcio"] == "Uno" and rows[0]["SERVICIOS PUBLICOS-Luz"] == "612.380,47"
    assert set(rows[1]) == {None} and rows[0].__fields__ == list(schemas.RAW_CHARGES)
    (tmp_path / "l.json").write_text('{"Mes": "abril"}\n{"Mes": "mayo"}\n')
    assert read_charges(spark, str(tmp_path / "l.json"), one_record_per_line=True).count() == 2


@pytest.mark.parametrize("indent", [None, 2])
def test_array_files_read_alike_in_many_splits(spark, tmp_path, indent):
    """Records cut by splits, braces and quotes inside of strings, nested objects, one object, no object."""
    odd = ['a}{b', '"}', '\\', '}\\"{', '', 'ñ}', '[{"x": 1}]', '\\"']
    files = {
        "many": [{"_id": {"$oid": {"k": k}}, "Mes": odd[k % len(odd)] * (k % 3), "n": k} for k in range(300)],
        "long": [{"Mes": "}{" * 4000, "n": 1}, {}, {"Mes": 'x"' * 3000, "n": 2}],
        "none": [],
    }
    for name, rows in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "one.json").write_text(json.dumps({"Mes": "solo", "n": {"m": 3}}))
    expected = sorted(json.dumps(r, sort_keys=True) for r in [*sum(files.values(), []), {"Mes": "solo", "n": {"m": 3}}])
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        records = array_records(spark, str(tmp_path))
        got = sorted(json.dumps(json.loads(r.record), sort_keys=True) for r in records.collect())
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == expected


def test_sheet_range_follows_the_row_number(spark, tmp_path):
    folder = tmp_path / "sheet"
    folder.mkdir()
    (folder / "b.csv").write_text("4,,Luz,Edesur,Cuenta 1,Uno\n31,,no,no,no,no\n")
    (folder / "a.csv").write_text("1,,titulo,,,\n2,,tipo,nombre,cuenta,grupo\n3,,Agua,Aysa,-,Dos,resto\n")
    rows = sheets.read_sheet_range(spark, str(folder), 3, 30, 2, 4).collect()
    assert sorted(tuple(r) for r in rows) == [("Agua", "Aysa", "-", "Dos"), ("Luz", "Edesur", "Cuenta 1", "Uno")]


def test_holidays_of_a_year(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("fecha,tipo,nombre\n2025-05-25,inamovible,Mayo\n25/05/2025,inamovible,Mayo\n2024-01-01,x,y\n")
    table = holidays.load_holidays(spark, str(path), 2025)
    assert [str(r.fecha) for r in table.collect()] == ["2025-05-25"]
    days = spark.createDataFrame([("2025-05-25",), ("2025-05-26",)], "t string").select(F.col("t").cast("date").alias("dia"))
    flags = holidays.with_is_holiday(days, "dia", table).orderBy("dia").collect()
    assert [r.es_feriado for r in flags] == [1, 0]


# --------------------------------------------------------------------------------------- store


def payment(i, day, unit=None, cbu="1"):
    return {"idDePago": i, "nroUnidadFuncional": unit, "fechaPago": day, "cbu": cbu, "monto": i}


def test_failed_publish_keeps_the_old_state(spark, table, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.load("pago").count() == 0
    store.publish(replace={"pago": table("pago", payment(1, "2025-04-01")), "feriado": table("feriado", {"fecha": "2025-01-01"})})
    broken = table("pago", payment(2, "2025-04-01")).withColumn("monto", F.raise_error(F.lit("no")).cast("decimal(18,2)"))
    with pytest.raises(Exception, match="no"):
        store.publish(replace={"feriado": table("feriado"), "pago": broken})
    assert store.load("pago").count() == store.load("feriado").count() == 1
    with pytest.raises(KeyError):
        store.publish(replace={"nada": table("pago")})
    store.overwrite("feriado")
    assert store.load("feriado").count() == 0


def test_append_and_replaced_months(spark, table, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.publish(replace={"pago": table("pago", payment(1, "2025-04-01"), payment(2, "2025-05-01"))})
    store.publish(append={"pago": table("pago", payment(3, "2025-05-09"))})
    store.publish(replace_months={"pago": (table("pago", payment(4, "2025-05-02")), [dt.date(2025, 5, 1)])})
    assert sorted(r.idDePago for r in store.load("pago").collect()) == [1, 4]
    april = dates.in_range(store.load("pago"), "fechaPago", "2025-04-01", "2025-04-30")
    assert [r.idDePago for r in april.collect()] == [1]
    plan = april._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "fechaPago_mes" in plan.split("PartitionFilters")[1].split("]")[0]
    # One folder a month, however often rows came.
    store.publish(append={"pago": table("pago", payment(5, "2025-04-09", unit=3))})
    assert sorted(r.idDePago for r in store.load("pago").collect()) == [1, 4, 5]
    assert sorted(store.current()["pago"]) == ["2025-04-01", "2025-05-01"]
    with pytest.raises(ValueError, match="2025-06-01"):
        store.publish(replace_months={"pago": (table("pago", payment(6, "2025-06-02")), [dt.date(2025, 5, 1)])})
    with pytest.raises(Exception, match="fechaPago is missing"):
        store.publish(append={"pago": table("pago", payment(6, None))})
    assert store.load("pago").count() == 3
    # A unit change reads only the folders of payments that wait.
    waiting = newly_linked(store.load("pago"), table("unidad", {"idUF": 7, "cbu_cvu_actual": "1"}))
    assert sorted(r.idDePago for r in waiting.collect()) == [1, 4]
    plan = waiting._jdf.queryExecution().executedPlan().toString()
    assert "espera" in plan.split("PartitionFilters")[1].split("]")[0]


def test_a_repeated_batch_does_nothing(spark, table, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.publish(replace={"pago": table("pago", payment(1, "2025-04-01", cbu="9"))})
    changed = spark.createDataFrame([(4, "9")], jobs.CHANGES)
    jobs.link_batch(store, changed, ("units", 0))
    before = store.current()
    assert store.last_batch("units") == 0 and store.load("pago").first().nroUnidadFuncional == 4
    jobs.link_batch(store, spark.createDataFrame([(5, "9")], jobs.CHANGES), ("units", 0))
    assert store.current() == before and store.last_batch("other") == -1


# --------------------------------------------------------------------------------------- streams


def test_files_are_imported_once(spark, table, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    landing, progress = tmp_path / "in", str(tmp_path / "progress")
    landing.mkdir()
    store.publish(replace={"unidad": table("unidad", {"idUF": 7, "idConsorcio": 1, "numeroUnidad": 1, "cbu_cvu_actual": "01"})})

    def run(checkpoint=progress):
        jobs.ingest_payments(spark, str(landing), store, checkpoint).awaitTermination()
        return sorted((r.idDePago, r.nroUnidadFuncional) for r in store.load("pago").collect())

    (landing / "a.csv").write_text("id,f,c,v\r\n1,25/04/2025,01,$ 5\r\n2,25/04/2025,99,7\r\n")
    assert run() == [(1, 7), (2, None)]
    (landing / "b.csv").write_text("id,f,c,v\r\n2,25/04/2025,99,7\r\n3,26/05/2025,01,7\r\n")
    assert run() == [(1, 7), (2, None), (3, 7)]
    # All files once more, as after a lost checkpoint.
    assert run(str(tmp_path / "other")) == [(1, 7), (2, None), (3, 7)]

    changes = tmp_path / "changes"
    spark.createDataFrame([(9, "99"), (8, "99"), (5, "01"), (4, None)], jobs.CHANGES).coalesce(1).write.parquet(str(changes))
    jobs.link_unit_changes(spark, str(changes), store, str(tmp_path / "links")).awaitTermination()
    got = sorted((r.idDePago, r.nroUnidadFuncional) for r in store.load("pago").collect())
    assert got == [(1, 7), (2, 8), (3, 7)]


# --------------------------------------------------------------------------------------- others


def test_encrypted_columns(spark, table):
    persons = table("persona", {"id": 1, "nombre": "Ana", "apellido": "Ñu", "dni": 1, "email": None})
    stored = privacy.encrypt_columns(persons, "0123456789abcdef")
    assert "nombre" not in stored.columns and dict(stored.dtypes)["nombre_encrypted"] == "binary"
    row = privacy.decrypt_columns(stored, "0123456789abcdef").first()
    assert (row.nombre, row.apellido, row.email) == ("Ana", "Ñu", None)
    wrong = privacy.decrypt_columns(stored, "fedcba9876543210").first()
    assert (wrong.nombre, wrong.apellido) == (None, None)


def test_numbers_are_dense_and_in_order(spark):
    rows = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("k")).repartition(7)
    target = spark.createDataFrame([(40,)], "id bigint")
    got = sorted((r.k, r.id) for r in identity.number_rows(rows, target, "id", ["k"]).collect())
    assert [i for _, i in got] == list(range(41, 2041))
    none = identity.number_rows(rows.limit(0), target.limit(0), "id", ["k"])
    assert none.count() == 0


def test_repeated_rows_are_all_accounted_for(spark):
    """A key with most rows: one row is kept and every other copy is reported."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"),
        (F.col("id") % 5).alias("v"),
        F.when(F.col("id") % 2 == 0, "a").alias("t"),
    )
    kept, rest = dedup.split_repeated(rows, ["k"])
    assert kept.count() == rows.select("k").distinct().count()
    assert kept.count() + rest.agg(F.sum("copias")).first()[0] == 3000
    lowest = {}
    for r in rows.collect():
        row = (r.v, r.t is not None, r.t)
        lowest[r.k] = min(lowest.get(r.k, row), row, key=lambda x: (x[0], x[1], x[2] or ""))
    assert {r.k: (r.v, r.t) for r in kept.collect()} == {k: (v, t) for k, (v, _, t) in lowest.items()}
    once = dedup.drop_repeated(rows, ["k"])
    assert once.count() + dedup.rows_of_repeated(rows, ["k"]).count() == 3000
