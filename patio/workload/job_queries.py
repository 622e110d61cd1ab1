"""Imports, linking, billing and stored-table jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.functions import privacy
from patio.functions.dates import MONTHS
from patio.operators import quality
from patio.plans import billing, imports, linking
from patio.schemas import RAW_CHARGES
from patio.sources.charges_json import parse_charges
from patio.sources.delimited import write_delimited
from patio.sources.tables import TableStore
from patio.streaming.jobs import ingest_payments
from patio.workload import raw
from patio.workload.answers import answer
from patio.workload.domain import Domain
from patio.workload.entry import Entry

ISSUED = "1998-06-25"
YEAR, MONTH = 1998, 6
BILLED_APARTMENT = "BUILDING"
PII_KEY = "0123456789abcdef"


# Part of the table is taken as already stored, so that imports meet known and new rows.
def stored_units(d: Domain) -> DataFrame:
    return d.units.filter("departamento <> 'MACHINERY'")


def stored_persons(d: Domain) -> DataFrame:
    return d.persons.filter("apellido <> 'MACHINERY'")


def stored_payments(d: Domain) -> DataFrame:
    known = d.read("orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("idDePago"))
    return d.payments.join(known, "idDePago", "left_semi")


def stored_charges(d: Domain) -> DataFrame:
    homes = d.units.filter("departamento = 'MACHINERY'").select("idUF")
    return d.charges.join(homes, "idUF", "left_semi").select(*d.charges.columns)


def charge_rows(d: Domain) -> DataFrame:
    records = raw.charge_records(d)
    return records.select("anio", parse_charges(F.col("json")).alias("r")).select(
        *[F.col(f"r.`{c}`") for c in RAW_CHARGES], "anio"
    )


def charge_import(d: Domain) -> imports.ChargeImport:
    return imports.import_charges(
        charge_rows(d),
        d.groups,
        d.units,
        d.accessories,
        d.providers,
        d.concept_map,
        stored_charges(d),
        F.col("anio"),
    )


def residual(d: Domain) -> DataFrame:
    amounts, _ = imports.monthly_amounts(charge_rows(d), d.groups, F.col("anio"))
    return imports.allocation_residual(amounts, d.units, d.accessories, d.providers, d.concept_map)


def payment_import(d: Domain) -> imports.PaymentImport:
    return imports.import_payments(raw.payments(d), d.units, stored_payments(d))


def balance(raw_rows: DataFrame, done: imports.TableImport, before: DataFrame, changed: list[str]) -> DataFrame:
    """Raw rows, and how many of them are neither taken (new or changed) nor rejected."""
    old = before.select("id", *[F.col(c).alias(f"_{c}") for c in changed])
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in changed])
    taken = done.table.join(old, "id", "left").where(differs)
    count = lambda df, value: df.agg(F.coalesce(value, F.lit(0)).alias("n")).withColumn("k", F.lit(1))
    parts = [
        count(raw_rows, F.count(F.lit(1))).withColumnRenamed("n", "filas"),
        count(taken, F.count(F.lit(1))).withColumnRenamed("n", "tomadas"),
        count(done.rejects, F.sum("copias")).withColumnRenamed("n", "rechazadas"),
    ]
    return reduce(lambda a, b: a.join(b, "k"), parts).select(
        "filas", (F.col("filas") - F.col("tomadas") - F.col("rechazadas")).alias("sobrantes")
    )


def unit_account_rejects(d: Domain) -> DataFrame:
    done = imports.import_unit_accounts(raw.unit_accounts(d), d.groups, stored_units(d))
    return done.rejects.groupBy("motivo").agg(F.sum("copias").alias("copias"))


def charge_rejects(d: Domain) -> DataFrame:
    """Records of some months carry an amount that cannot be read."""
    rows = charge_rows(d)
    broken = F.lower(F.trim("Mes")).isin([m for i, m in enumerate(MONTHS, 1) if i % 5 == 2])
    rows = rows.withColumn("LIMPIEZA", F.when(broken, F.lit("abc")).otherwise(F.col("LIMPIEZA")))
    _, rejects = imports.monthly_amounts(rows, d.groups, F.col("anio"))
    return rejects.groupBy("motivo").agg(F.sum("copias").alias("copias"))


def month_bill(d: Domain) -> billing.MonthBill:
    """A month where some units already have their invoice and statement."""
    done = d.units.filter(F.col("departamento") == BILLED_APARTMENT).select("idUF")
    history = billing.bill_history(d.charges, d.payments)
    start = F.lit(f"{YEAR}-{MONTH:02d}-01").cast("date")
    earlier = history.filter(F.col("periodo") < start)
    same_month = history.filter(F.col("periodo") == start).join(done, "idUF", "left_semi")
    invoices = d.charges.join(done, "idUF", "left_semi").select(F.col("id").alias("idExpensa"))
    return billing.bill_month(
        d.charges,
        d.details,
        d.payments,
        invoices,
        earlier.unionByName(same_month.select(*earlier.columns)),
        d.holidays,
        YEAR,
        MONTH,
        ISSUED,
    )


def send_date(d: Domain) -> DataFrame:
    return month_bill(d).charges.select("id", "fechaEnvio")


def stream_import(d: Domain) -> DataFrame:
    """Files land, are imported as a stream, and are imported again to no effect."""
    store = TableStore(d.spark, d.scratch("store"))
    landing, progress = d.scratch("landing"), d.scratch("progress")
    store.publish(replace={"unidad": d.units})
    write_delimited(raw.payments(d), landing, ",")
    for _ in range(2):
        ingest_payments(d.spark, landing, store, progress).awaitTermination()
    ingest_payments(d.spark, landing, store, d.scratch("progress")).awaitTermination()
    return store.load("pago").select("idDePago", "nroUnidadFuncional", "fechaPago", "cbu", "monto")


def overwrite(d: Domain) -> DataFrame:
    store = TableStore(d.spark, d.scratch("store"))
    store.overwrite("persona", d.persons)
    store.overwrite("persona", d.persons.filter("tipoTitularidad = 'Propietario'"))
    return store.load("persona")


def pii(d: Domain) -> DataFrame:
    stored = privacy.encrypt_columns(d.persons, PII_KEY)
    right = privacy.decrypt_columns(stored, PII_KEY)
    wrong = privacy.decrypt_columns(stored, PII_KEY[::-1])
    hidden = F.coalesce(*privacy.PERSONAL).isNull().alias("clave_errada_oculta")
    return right.select("dni", *privacy.PERSONAL).join(wrong.select("dni", hidden), "dni")


# A charge with lines has both sums; one without has no row here.
LINE_SUMS = """
SELECT idExpensa, coalesce(sum(importe) FILTER (categoria <> 'EXTRAORDINARIO'), 0) AS comun,
       coalesce(sum(importe) FILTER (categoria = 'EXTRAORDINARIO'), 0) AS extra FROM detalle GROUP BY idExpensa"""
GOOD_PAYMENT = "o_orderkey % 50 <> 7 AND o_orderkey % 41 <> 5 AND o_orderkey % 43 <> 11 AND o_orderkey % 37 <> 3"
PAYMENT_COLUMNS = """
SELECT o_orderkey AS idDePago, t.idUF AS nroUnidadFuncional, CAST(o_orderdate AS DATE) AS fechaPago,
       lpad(CAST(o_custkey AS VARCHAR), 22, '0') AS cbu, CAST(o_totalprice AS DECIMAL(18,2)) AS monto
FROM orders LEFT JOIN titular t ON t.cbu = lpad(CAST(o_custkey AS VARCHAR), 22, '0')"""

NEW_UNIT = "(SELECT coalesce(max(idUF), 0) FROM base)"
UNIT_BASE = "base AS (SELECT * FROM uf WHERE departamento <> 'MACHINERY')"

# Centavos per unit and month, for units whose month is not stored yet.
SHARE_TOTALS = """
tot AS (SELECT p.idUF, p.periodo, CAST(sum(centavos) AS BIGINT) AS centavos FROM parte p GROUP BY 1, 2),
nuevas AS (
  SELECT t.* FROM tot t JOIN uf USING (idUF) WHERE t.centavos > 0
  AND NOT (uf.departamento = 'MACHINERY'
           AND EXISTS (SELECT 1 FROM expensa e WHERE e.idUF = t.idUF AND e.periodo = t.periodo)))"""
CHARGE_ID = "{0}.idUF * 100000 + year({0}.periodo) * 12 + month({0}.periodo) - 1"

QUERIES: dict[str, Entry] = {
    "job_i1_charges": Entry(
        lambda d: charge_import(d).charges.select("id", "idUF", "periodo", "montoTotal"),
        answer(
            "parte uf expensa",
            f"""
WITH {SHARE_TOTALS}
SELECT {CHARGE_ID.format('n')} AS id, idUF, periodo, CAST(centavos * 0.01 AS DECIMAL(18,2)) AS montoTotal
FROM nuevas n""",
        ),
    ),
    "job_i1_detail": Entry(
        lambda d: charge_import(d).details.drop("nroFactura", "periodo"),
        answer(
            "parte uf expensa prestador concepto",
            f"""
WITH {SHARE_TOTALS}
SELECT {CHARGE_ID.format('p')} AS idExpensa, ps.id AS idPrestadorServicio,
       CAST(p.centavos * 0.01 AS DECIMAL(18,2)) AS importe, c.tipoServicio AS tipo, c.categoria
FROM parte p JOIN nuevas n USING (idUF, periodo) JOIN concepto c USING (orden)
JOIN prestador ps ON ps.idConsorcio = p.idConsorcio AND ps.tipoServicio = c.tipoServicio
WHERE p.centavos > 0""",
        ),
    ),
    "job_i1_residual": Entry(
        residual,
        answer(
            "parte monto prestador concepto",
            """
WITH edificio AS (SELECT idConsorcio, periodo, sum(monto) AS total FROM monto GROUP BY 1, 2),
reparto AS (
  SELECT idConsorcio, periodo, sum(centavos) AS c FROM parte GROUP BY 1, 2),
lineas AS (
  SELECT p.idConsorcio, p.periodo, sum(p.centavos) AS c FROM parte p JOIN concepto k USING (orden)
  JOIN prestador ps ON ps.idConsorcio = p.idConsorcio AND ps.tipoServicio = k.tipoServicio GROUP BY 1, 2),
n AS (
  SELECT e.idConsorcio, e.periodo, CAST(e.total AS DECIMAL(28,2)) AS total,
         CAST(CAST(coalesce(r.c, 0) AS DECIMAL(30,0)) * 0.01 AS DECIMAL(28,2)) AS repartido,
         CAST(CAST(coalesce(l.c, 0) AS DECIMAL(30,0)) * 0.01 AS DECIMAL(28,2)) AS detallado
  FROM edificio e LEFT JOIN reparto r USING (idConsorcio, periodo) LEFT JOIN lineas l USING (idConsorcio, periodo))
SELECT *, CAST(repartido - total AS DECIMAL(28,2)) AS resto_reparto,
       CAST(detallado - repartido AS DECIMAL(28,2)) AS resto_detalle FROM n""",
        ),
    ),
    "job_i2_payments": Entry(
        lambda d: payment_import(d).payments,
        answer("titular", f"{PAYMENT_COLUMNS} WHERE {GOOD_PAYMENT} AND o_orderstatus <> 'F'"),
    ),
    "job_i3_groups": Entry(
        lambda d: imports.import_groups(raw.groups(d), d.groups).table,
        answer(
            "consorcio",
            """
WITH limpio AS (
  SELECT CASE WHEN s_suppkey % 5 = 0 THEN lower(n_name) ELSE s_name END AS nombre, 'Av. ' || s_suppkey AS domicilio,
         CAST(s_suppkey % 90 + 5 AS INTEGER) AS cantidadUnidades, CAST(s_suppkey % 5000 + 1000 AS INTEGER) AS m2totales
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
  WHERE s_suppkey % 17 <> 2 AND s_suppkey % 11 <> 3),
uno AS (
  SELECT * FROM limpio
  QUALIFY row_number() OVER (PARTITION BY lower(nombre) ORDER BY nombre, domicilio, cantidadUnidades, m2totales) = 1)
SELECT c.id, c.nombre, coalesce(u.domicilio, c.domicilio) AS domicilio,
       coalesce(u.cantidadUnidades, c.cantidadUnidades) AS cantidadUnidades, coalesce(u.m2totales, c.m2totales) AS m2totales
FROM consorcio c LEFT JOIN uno u ON lower(u.nombre) = lower(c.nombre)
UNION ALL
SELECT (SELECT max(id) FROM consorcio) + row_number() OVER (ORDER BY nombre), nombre, domicilio, cantidadUnidades, m2totales
FROM uno WHERE lower(nombre) NOT IN (SELECT lower(nombre) FROM consorcio)""",
        ),
    ),
    "job_i4_providers": Entry(
        lambda d: imports.import_providers(raw.providers(d), d.groups, d.providers).table,
        answer(
            "prestador",
            """
WITH fuente AS (
  SELECT CAST(s_nationkey AS BIGINT) AS idConsorcio, s_name AS nombre,
         CASE WHEN s_suppkey % 3 = 0 THEN 'otro servicio' ELSE 'SERVICIO ' || (s_suppkey % 7) END AS tipoServicio,
         CASE s_suppkey % 4 WHEN 0 THEN '00' || s_suppkey || '345' WHEN 3 THEN s_suppkey || '77' END AS cuenta
  FROM supplier WHERE (s_suppkey % 3 = 0 OR s_suppkey % 19 <> 4) AND s_suppkey % 13 <> 5)
SELECT p.id, p.idConsorcio, p.nombre, p.tipoServicio,
       CASE WHEN f.nombre IS NOT NULL THEN f.cuenta ELSE p.cuenta END AS cuenta
FROM prestador p LEFT JOIN fuente f ON f.idConsorcio = p.idConsorcio AND f.nombre = p.nombre
     AND lower(f.tipoServicio) = p.tipoServicio
UNION ALL
SELECT (SELECT max(id) FROM prestador) + row_number() OVER (ORDER BY idConsorcio, nombre, tipoServicio),
       idConsorcio, nombre, tipoServicio, cuenta
FROM fuente WHERE tipoServicio = 'otro servicio'""",
        ),
    ),
    "job_i5_unit_accounts": Entry(
        lambda d: imports.import_unit_accounts(raw.unit_accounts(d), d.groups, stored_units(d)).units,
        answer(
            "uf",
            f"""
WITH {UNIT_BASE},
fuente AS (
  SELECT CAST(c_nationkey AS BIGINT) AS idConsorcio, c_custkey AS numeroUnidad,
         CASE WHEN c_custkey % 6 <> 1 THEN 'D' || (c_custkey % 40) END AS departamento,
         CASE WHEN c_custkey % 9 <> 4 THEN lpad(CAST(c_custkey + 7 AS VARCHAR), 20, '0') END AS cbu
  FROM customer WHERE c_custkey % 17 <> 3 AND c_custkey % 23 <> 7)
SELECT b.idUF, b.idConsorcio, b.numeroUnidad, b.piso, coalesce(f.departamento, b.departamento) AS departamento,
       b.coeficiente, b.m2_UF, coalesce(f.cbu, b.cbu_cvu_actual) AS cbu_cvu_actual
FROM base b LEFT JOIN fuente f USING (idConsorcio, numeroUnidad)
UNION ALL
SELECT {NEW_UNIT} + row_number() OVER (ORDER BY idConsorcio, numeroUnidad), idConsorcio, numeroUnidad, NULL,
       departamento, CAST(0 AS DECIMAL(3,1)), 1, cbu
FROM fuente f WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.idConsorcio = f.idConsorcio AND b.numeroUnidad = f.numeroUnidad)""",
        ),
    ),
    "job_i6_persons": Entry(
        lambda d: imports.import_persons(raw.persons(d), stored_persons(d)).table,
        answer(
            "persona",
            """
WITH base AS (SELECT * FROM persona WHERE apellido <> 'MACHINERY'),
fuente AS (
  SELECT c_custkey + 10000000 AS dni, 'N ' || c_custkey AS nombre, 'A ' || c_custkey AS apellido,
         CASE WHEN c_custkey % 8 <> 2 THEN 'p' || c_custkey || '@x.org' END AS email,
         '11' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS telefono,
         CASE WHEN c_custkey % 5 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 22, '0') END AS cbu_cvu,
         CASE WHEN c_custkey % 2 = 1 THEN 'Inquilino' ELSE 'Propietario' END AS tipoTitularidad
  FROM customer WHERE c_custkey % 11 <> 3 AND c_custkey % 47 <> 8 AND c_custkey % 13 <> 4
    AND c_custkey + 10000000 <= 99999999)
SELECT b.id, coalesce(f.nombre, b.nombre) AS nombre, coalesce(f.apellido, b.apellido) AS apellido, b.dni,
       CASE WHEN f.dni IS NULL THEN b.email ELSE f.email END AS email, coalesce(f.telefono, b.telefono) AS telefono,
       CASE WHEN f.dni IS NULL THEN b.cbu_cvu ELSE f.cbu_cvu END AS cbu_cvu,
       coalesce(f.tipoTitularidad, b.tipoTitularidad) AS tipoTitularidad
FROM base b LEFT JOIN fuente f USING (dni)
UNION ALL
SELECT (SELECT max(id) FROM base) + row_number() OVER (ORDER BY dni), nombre, apellido, dni, email, telefono,
       cbu_cvu, tipoTitularidad
FROM fuente WHERE dni NOT IN (SELECT dni FROM base)""",
        ),
    ),
    "job_i7_units": Entry(
        lambda d: imports.import_units(raw.units(d), d.groups, stored_units(d), d.accessories).units,
        answer(
            "uf",
            f"""
WITH {UNIT_BASE},
fuente AS (
  SELECT CAST(c_nationkey AS BIGINT) AS idConsorcio, c_custkey AS numeroUnidad,
         CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 9 AS SMALLINT) END AS piso,
         CASE WHEN c_custkey % 6 <> 1 THEN 'D' || (c_custkey % 40) END AS departamento,
         CAST(CASE WHEN c_custkey % 7 = 3 THEN 0 ELSE (c_custkey % 40) + (c_custkey % 10) * 0.1 END AS DECIMAL(3,1)) AS coeficiente,
         CAST(CASE WHEN c_custkey % 10 = 6 THEN 1 ELSE c_custkey % 80 + 15 END AS INTEGER) AS m2_UF
  FROM customer WHERE c_custkey % 23 <> 7 AND c_custkey % 59 <> 1 AND c_custkey % 61 <> 2 AND c_custkey % 53 <> 9)
SELECT b.idUF, b.idConsorcio, b.numeroUnidad, coalesce(f.piso, b.piso) AS piso,
       coalesce(f.departamento, b.departamento) AS departamento, coalesce(f.coeficiente, b.coeficiente) AS coeficiente,
       coalesce(f.m2_UF, b.m2_UF) AS m2_UF, b.cbu_cvu_actual
FROM base b LEFT JOIN fuente f USING (idConsorcio, numeroUnidad)
UNION ALL
SELECT {NEW_UNIT} + row_number() OVER (ORDER BY idConsorcio, numeroUnidad), idConsorcio, numeroUnidad, piso,
       departamento, coeficiente, m2_UF, NULL
FROM fuente f WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.idConsorcio = f.idConsorcio AND b.numeroUnidad = f.numeroUnidad)""",
        ),
    ),
    "job_i7_accessories": Entry(
        lambda d: imports.import_units(raw.units(d), d.groups, d.units, d.accessories).accessories,
        answer(
            "accesoria",
            """
WITH fuente AS (
  SELECT c_custkey AS id, c_custkey % 5 = 0 AS cochera, c_custkey % 3 = 0 AS baulera,
         CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 7 + 1 ELSE 0 END AS INTEGER) AS m2_baulera,
         CAST(CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 11 + 1 ELSE 0 END AS INTEGER) AS m2_cochera
  FROM customer WHERE c_custkey % 23 <> 7 AND c_custkey % 59 <> 1 AND c_custkey % 61 <> 2 AND c_custkey % 53 <> 9)
SELECT id AS idUnidadFuncional, cochera, baulera, m2_baulera, m2_cochera FROM fuente
UNION ALL
SELECT * FROM accesoria WHERE idUnidadFuncional NOT IN (SELECT id FROM fuente)""",
        ),
    ),
    "job_i3_rejects": Entry(
        lambda d: balance(raw.groups(d), imports.import_groups(raw.groups(d), d.groups), d.groups, ["domicilio"]),
        answer("", "SELECT count(*) AS filas, CAST(0 AS BIGINT) AS sobrantes FROM supplier"),
    ),
    "job_i5_rejects": Entry(
        unit_account_rejects,
        answer(
            "",
            f"""
SELECT motivo, count(*) AS copias FROM (
  SELECT CASE WHEN c_custkey % 17 = 3 THEN 'cuenta' WHEN c_custkey % 23 = 7 THEN 'grupo desconocido' END AS motivo
  FROM customer, range(CASE WHEN c_custkey % 19 = 6 THEN 2 ELSE 1 END) r(copia)
  WHERE copia = 0 OR c_custkey % 17 = 3
  UNION ALL SELECT 'clave repetida' FROM customer WHERE c_custkey % 19 = 6 AND c_custkey % 17 <> 3)
WHERE motivo IS NOT NULL GROUP BY motivo""",
        ),
    ),
    "job_i1_rejects": Entry(
        charge_rejects,
        answer(
            "monto",
            f"""
SELECT 'importe ilegible' AS motivo, count(*) AS copias
FROM (SELECT DISTINCT idConsorcio, periodo FROM monto) WHERE month(periodo) % 5 = 2""",
        ),
    ),
    "job_t1_link_payments": Entry(
        lambda d: linking.link_payments(d.payments, d.units.select("idUF", "cbu_cvu_actual")),
        answer(
            "pago titular",
            """
SELECT idDePago, coalesce(p.nroUnidadFuncional, t.idUF) AS nroUnidadFuncional, fechaPago, cbu, monto
FROM pago p LEFT JOIN titular t USING (cbu)""",
        ),
    ),
    "job_t2_incremental": Entry(
        stream_import, answer("titular", f"{PAYMENT_COLUMNS} WHERE {GOOD_PAYMENT}")
    ),
    "job_b1_invoices": Entry(
        lambda d: month_bill(d).invoices.drop("periodo"),
        answer(
            "detalle expensa uf",
            f"""
SELECT e.id AS numeroFactura, e.id AS idExpensa, DATE '{ISSUED}' AS fechaEmision, DATE '{ISSUED}' + 10 AS fechaVencimiento,
       1 AS nroVencimiento, CAST(0 AS DECIMAL(18,2)) AS interesPorMora,
       CAST(g.comun AS DECIMAL(18,2)) AS totalGastoOrdinario,
       CAST(coalesce(g.extra, 0) AS DECIMAL(18,2)) AS totalGastoExtraordinario
FROM expensa e JOIN uf USING (idUF) LEFT JOIN ({LINE_SUMS}) g ON g.idExpensa = e.id
WHERE e.periodo = DATE '{YEAR}-{MONTH:02d}-01' AND uf.departamento <> '{BILLED_APARTMENT}'""",
        ),
    ),
    "job_b1_statements": Entry(
        lambda d: month_bill(d).statements,
        answer(
            "historia uf",
            f"""
SELECT h.idExpensa, h.idUF, h.periodo, h.saldoAnterior, h.saldoNuevo,
       greatest(h.saldoNuevo, CAST(0 AS DECIMAL(18,2))) AS saldoDeudor,
       greatest(-h.saldoNuevo, CAST(0 AS DECIMAL(18,2))) AS saldoAdelantado, h.saldoNuevo AS saldoTotal
FROM historia h JOIN uf USING (idUF)
WHERE h.periodo = DATE '{YEAR}-{MONTH:02d}-01' AND uf.departamento <> '{BILLED_APARTMENT}'""",
        ),
    ),
    "job_send_date": Entry(
        send_date,
        answer(
            "expensa feriado",
            f"""
SELECT id, (SELECT min(dia) FROM (SELECT DATE '{ISSUED}' + CAST(i AS INTEGER) AS dia FROM range(11) t(i))
            WHERE dia NOT IN (SELECT fecha FROM feriado)) AS fechaEnvio
FROM expensa WHERE periodo = DATE '{YEAR}-{MONTH:02d}-01'""",
        ),
    ),
    "job_b2_statement_history": Entry(
        lambda d: billing.bill_history(d.charges, d.payments),
        answer(
            "historia",
            """
SELECT idExpensa, idUF, periodo, saldoAnterior, saldoNuevo,
       greatest(saldoNuevo, CAST(0 AS DECIMAL(18,2))) AS saldoDeudor,
       greatest(-saldoNuevo, CAST(0 AS DECIMAL(18,2))) AS saldoAdelantado, saldoNuevo AS saldoTotal
FROM historia""",
        ),
    ),
    "job_pii_roundtrip": Entry(
        pii,
        answer("persona", "SELECT dni, nombre, apellido, email, telefono, TRUE AS clave_errada_oculta FROM persona"),
    ),
    "w_overwrite": Entry(
        overwrite,
        answer("persona", "SELECT * FROM persona WHERE tipoTitularidad = 'Propietario'"),
    ),
    "flt_rejects": Entry(
        lambda d: quality.split_valid(imports.clean_payments(raw.payments(d)), imports.payment_rules())[1]
        .groupBy("motivo", "idDePago")
        .agg(F.count(F.lit(1)).alias("filas")),
        answer(
            "",
            """
SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'id' WHEN o_orderkey % 41 = 5 THEN 'fecha'
            WHEN o_orderkey % 43 = 11 THEN 'monto' ELSE 'cuenta' END AS motivo,
       CASE WHEN o_orderkey % 50 <> 7 THEN o_orderkey END AS idDePago,
       CAST(sum(CASE WHEN o_orderkey % 31 = 6 OR o_orderkey % 29 = 4 THEN 2 ELSE 1 END) AS BIGINT) AS filas
FROM orders WHERE o_orderkey % 50 = 7 OR o_orderkey % 41 = 5 OR o_orderkey % 43 = 11 OR o_orderkey % 37 = 3
GROUP BY 1, 2""",
        ),
    ),
    "flt_valid_rows": Entry(
        lambda d: quality.split_valid(imports.clean_payments(raw.payments(d)), imports.payment_rules())[0].select(
            "idDePago", "fechaPago", "cbu", F.col("monto").cast("decimal(18,2)").alias("monto")
        ),
        answer(
            "",
            f"""
SELECT o_orderkey AS idDePago, CAST(o_orderdate AS DATE) AS fechaPago,
       lpad(CAST(o_custkey AS VARCHAR), 22, '0') AS cbu,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) + v.mas AS DECIMAL(18,2)) AS monto
FROM orders JOIN (VALUES (0, 0), (1, 0), (1, 0), (2, 0), (2, 1)) v(tipo, mas)
  ON v.tipo = CASE WHEN o_orderkey % 31 = 6 THEN 1 WHEN o_orderkey % 29 = 4 THEN 2 ELSE 0 END
WHERE {GOOD_PAYMENT}""",
        ),
    ),
    "job_i2_repeated": Entry(
        lambda d: payment_import(d)
        .rejects.filter(F.col("motivo") == imports.REPEATED)
        .groupBy("motivo")
        .agg(F.sum("copias").alias("copias")),
        answer(
            "",
            f"""
SELECT 'clave repetida' AS motivo, count(*) AS copias FROM orders
WHERE {GOOD_PAYMENT} AND (o_orderkey % 31 = 6 OR o_orderkey % 29 = 4)""",
        ),
    ),
}
