"""Reports, building profiles and counts over the whole span of the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.plans import profile, reports
from patio.sources import holidays, xml
from patio.workload.answers import answer
from patio.workload.domain import MONTHS, Domain
from patio.workload.entry import Entry

CUTOFF = "2001-07-15"


def cashflow(d: Domain) -> DataFrame:
    weeks = reports.weekly_cashflow(d.payments, d.units, *d.span)
    return weeks.withColumn("promedio_periodo", F.col("promedio_periodo").cast("decimal(18,2)"))


def pivot(d: Domain) -> DataFrame:
    return reports.month_by_apartment(d.payments, d.units, d.groups, *d.span)


def gaps(d: Domain) -> DataFrame:
    return reports.payment_gaps(d.payments, d.units, d.groups, *d.span)


def nested(d: Domain) -> DataFrame:
    """A chunk holds few payments here, so that units have several."""
    blocks = reports.payment_gaps_nested(d.payments, d.units, d.groups, *d.span, chunk=4)
    one = F.transform(
        "pagos",
        lambda x: F.concat_ws(
            ":", x.fecha.cast("string"), x.idDePago.cast("string"), x.dias_hasta_siguiente.cast("string")
        ),
    )
    return blocks.select("idUF", "numeroUnidad", "consorcio", "bloque", F.array_join(one, "|").alias("pagos"))


def empty_guard(d: Domain) -> DataFrame:
    """A range without payments is told from one with payments before anything is pivoted."""
    first, last = d.span
    before = str(dt.date.fromisoformat(first) - dt.timedelta(days=1))
    found = []
    for label, span in (("antes", ("1900-01-01", before)), ("todo", (first, last))):
        wide = reports.month_by_apartment(d.payments, d.units, d.groups, *span)
        found.append((label, len(wide.columns) - 2, wide.isEmpty()))
    return d.spark.createDataFrame(found, "rango string, meses int, vacio boolean")


def debtors(d: Domain) -> DataFrame:
    return reports.top_debtors(d.persons, d.units, d.payments, d.charges, CUTOFF, n=20)


def building_profile(d: Domain) -> DataFrame:
    return profile.building_profile(d.groups, d.units, d.accessories)


def xml_lines(d: Domain, siblings: bool) -> DataFrame:
    marked = reports.payment_gaps(d.payments, d.units, d.groups, *d.span, marks=True)
    return xml.in_document_order(reports.payment_gaps_xml(marked, siblings))


def xml_nested(d: Domain) -> DataFrame:
    return xml_lines(d, siblings=False)


def xml_siblings(d: Domain) -> DataFrame:
    return xml_lines(d, siblings=True)


PIVOT_CELLS = ",\n".join(
    f"CAST(coalesce(sum(monto) FILTER (WHERE mes = '{m}'), 0) AS DECIMAL(38,2)) AS m_{m.replace('-', '_')}"
    for m in MONTHS
)
PIVOT_TEXT = " || ' ' || ".join(
    f"'m_{m.replace('-', '_')}=\"' || CAST(coalesce(sum(monto) FILTER (WHERE mes = '{m}'), 0) AS DECIMAL(38,2)) || '\"'"
    for m in MONTHS
)
PIVOT_FROM = """
FROM (SELECT c.nombre AS consorcio, u.departamento, strftime(p.fechaPago, '%Y-%m') AS mes, p.monto
      FROM pago p JOIN uf u ON u.idUF = p.nroUnidadFuncional JOIN consorcio c ON c.id = u.idConsorcio) b
GROUP BY consorcio, departamento"""

# Each unit says what rooms it has; buildings count their units.
PROFILE = """
WITH cuartos AS (
  SELECT idUnidadFuncional AS idUF, bool_or(baulera) AS guarda, bool_or(cochera) AS estaciona
  FROM accesoria GROUP BY ALL),
perfil AS (
  SELECT idConsorcio AS id, any_value(nombre) AS nombre, count(*) AS cantUF,
         count(*) FILTER (guarda) AS ufs_con_baulera, count(*) FILTER (estaciona) AS ufs_con_cochera,
         count(*) FILTER (guarda OR estaciona) AS ufs_con_accesorios
  FROM (SELECT idUF, idConsorcio FROM uf) LEFT JOIN cuartos USING (idUF)
  JOIN (SELECT id AS idConsorcio, nombre FROM consorcio) USING (idConsorcio) GROUP BY idConsorcio)
"""
GAPS = """
  SELECT u.idUF, u.numeroUnidad, c.nombre AS consorcio, p.idDePago, p.fechaPago AS fecha,
         CAST(lead(p.fechaPago) OVER (PARTITION BY p.nroUnidadFuncional ORDER BY p.fechaPago, p.idDePago)
              - p.fechaPago AS INTEGER) AS dias_hasta_siguiente
  FROM pago p JOIN uf u ON u.idUF = p.nroUnidadFuncional JOIN consorcio c ON c.id = u.idConsorcio"""
PROFILE_TABLES = "consorcio uf accesoria"

ORIGIN = """
  SELECT e.periodo AS mes, d.importe, coalesce(d.tipo, '') = 'Extraordinario' AS extra
  FROM detalle d JOIN expensa e ON e.id = d.idExpensa JOIN uf u ON u.idUF = e.idUF"""


def _profile_sql(columns: str, where: str) -> str:
    return answer(PROFILE_TABLES, f"{PROFILE} SELECT id, nombre, cantUF, {columns} FROM perfil WHERE {where}")


QUERIES: dict[str, Entry] = {
    "q_r1_weekly_cashflow": Entry(
        cashflow,
        answer(
            "pago uf",
            """
WITH semanas AS (
  SELECT CAST(date_trunc('week', p.fechaPago + 1) AS DATE) AS semana_ini, sum(p.monto) AS total_semana
  FROM pago p JOIN uf u ON u.idUF = p.nroUnidadFuncional GROUP BY 1)
SELECT semana_ini, semana_ini + 6 AS semana_fin, total_semana,
       CAST(sum(total_semana) OVER () / count(*) OVER () AS DECIMAL(18,2)) AS promedio_periodo,
       CAST(sum(total_semana) OVER (ORDER BY semana_ini) AS DECIMAL(38,2)) AS acumulado
FROM semanas""",
        ),
    ),
    "q_r2_pivot": Entry(
        pivot,
        answer("pago uf consorcio", f"SELECT consorcio, departamento, {PIVOT_CELLS} {PIVOT_FROM}"),
    ),
    "flt_empty_guard": Entry(
        empty_guard,
        answer(
            "pago uf",
            """
WITH p AS (SELECT strftime(fechaPago, '%Y-%m') AS mes FROM pago JOIN uf ON idUF = nroUnidadFuncional)
SELECT 'todo' AS rango, CAST(count(DISTINCT mes) AS INTEGER) AS meses, count(*) = 0 AS vacio FROM p
UNION ALL SELECT 'antes', 0, true""",
        ),
    ),
    "w_xml_rows": Entry(
        lambda d: reports.month_by_apartment_xml(pivot(d)),
        answer(
            "pago uf consorcio",
            "SELECT '<row consorcio=\"' || consorcio || '\" depto=\"' || departamento || '\" ' || "
            f"{PIVOT_TEXT} || '/>' AS xml {PIVOT_FROM}",
        ),
    ),
    "q_r3_by_origin": Entry(
        lambda d: reports.by_origin(d.charges, d.details, d.units, *d.span),
        answer(
            "detalle expensa uf",
            f"""
WITH base AS ({ORIGIN})
SELECT mes AS periodo, CAST(coalesce(sum(importe) FILTER (WHERE NOT extra), 0) AS DECIMAL(38,2)) AS "Ordinario",
       CAST(coalesce(sum(importe) FILTER (WHERE extra), 0) AS DECIMAL(38,2)) AS "Extraordinario",
       CAST(sum(importe) AS DECIMAL(38,2)) AS "Total"
FROM base GROUP BY mes""",
        ),
    ),
    "q_r4_top_months": Entry(
        lambda d: reports.top_months(d.payments, d.charges, d.details, d.units, "1995-01-10", "2001-06-20"),
        answer(
            "pago detalle expensa uf",
            f"""
WITH base AS ({ORIGIN}),
totales AS (
  SELECT 'INGRESOS' AS tipo, CAST(date_trunc('month', p.fechaPago) AS DATE) AS mes, sum(p.monto) AS total
  FROM pago p JOIN uf u ON u.idUF = p.nroUnidadFuncional
  WHERE p.fechaPago BETWEEN DATE '1995-01-10' AND DATE '2001-06-20' GROUP BY 2
  UNION ALL
  SELECT 'GASTOS', mes, sum(importe) FROM base
  WHERE mes >= DATE '1995-01-01' AND mes < DATE '2001-07-01' GROUP BY mes),
puestos AS (
  SELECT tipo, mes, CAST(total AS DECIMAL(38,2)) AS total,
         CAST(row_number() OVER (PARTITION BY tipo ORDER BY total DESC, mes DESC) AS INTEGER) AS rango
  FROM totales)
SELECT * FROM puestos WHERE rango <= 5""",
        ),
    ),
    "q_r5_top_debtors": Entry(
        debtors,
        answer(
            "persona uf pago expensa",
            f"""
WITH movimiento AS (
  SELECT idUF, montoTotal AS debe, 0 AS haber FROM expensa
  WHERE periodo < date_trunc('month', DATE '{CUTOFF}') + INTERVAL 1 MONTH
  UNION ALL
  SELECT nroUnidadFuncional, 0, monto FROM pago WHERE fechaPago <= DATE '{CUTOFF}'),
cuenta AS (
  SELECT cbu_cvu_actual AS cbu_cvu, count(DISTINCT idUF) AS unidades, sum(debe) AS debe, sum(haber) AS haber
  FROM uf LEFT JOIN movimiento USING (idUF) GROUP BY cbu_cvu_actual)
-- One row for each unit of the account.
SELECT nombre, apellido, dni, email, telefono, CAST(haber AS DECIMAL(28,2)) AS pagos,
       CAST(debe AS DECIMAL(28,2)) AS expen, CAST(debe - haber AS DECIMAL(28,2)) AS deuda
FROM persona JOIN cuenta USING (cbu_cvu), range(unidades)
WHERE tipoTitularidad = 'Inquilino' AND debe > haber
ORDER BY deuda DESC, apellido, nombre, dni LIMIT 20""",
        ),
    ),
    "q_r6_payment_gaps": Entry(gaps, answer("pago uf consorcio", GAPS)),
    "agg_nested": Entry(
        nested,
        answer(
            "pago uf consorcio",
            f"""
WITH g AS ({GAPS}),
n AS (SELECT *, (row_number() OVER (PARTITION BY idUF ORDER BY fecha, idDePago) - 1) // 4 AS bloque FROM g)
SELECT idUF, numeroUnidad, consorcio, bloque,
       string_agg(concat_ws(':', CAST(fecha AS VARCHAR), CAST(idDePago AS VARCHAR), CAST(dias_hasta_siguiente AS VARCHAR)),
                  '|' ORDER BY fecha, idDePago) AS pagos
FROM n GROUP BY idUF, numeroUnidad, consorcio, bloque""",
        ),
    ),
    "w_xml_nested": Entry(
        xml_nested,
        answer(
            "pago uf consorcio",
            f"""
WITH g AS ({GAPS})
SELECT '<pago fecha="' || CAST(fecha AS VARCHAR) || '"' ||
       coalesce(' dias_hasta_siguiente="' || dias_hasta_siguiente || '"', '') || '/>' AS xml FROM g
UNION ALL
SELECT '<UF idUF="' || idUF || '" nro="' || numeroUnidad || '" consorcio="' || consorcio || '">'
FROM (SELECT DISTINCT idUF, numeroUnidad, consorcio FROM g)
UNION ALL SELECT '</UF>' FROM (SELECT DISTINCT idUF, numeroUnidad, consorcio FROM g)""",
        ),
    ),
    "w_xml_siblings": Entry(
        xml_siblings,
        answer(
            "pago uf consorcio",
            f"""
WITH g AS ({GAPS})
SELECT '<pago fecha="' || CAST(fecha AS VARCHAR) || '"' ||
       coalesce(' dias_hasta_siguiente="' || dias_hasta_siguiente || '"', '') || '/>' AS xml FROM g
UNION ALL
SELECT DISTINCT '<UF idUF="' || idUF || '" nro="' || numeroUnidad || '" consorcio="' || consorcio || '"/>' FROM g""",
        ),
    ),
    "q_a1_both": Entry(
        lambda d: profile.with_both(building_profile(d)),
        _profile_sql("ufs_con_baulera, ufs_con_cochera", "ufs_con_baulera > 0 AND ufs_con_cochera > 0"),
    ),
    "q_a2_none": Entry(
        lambda d: profile.with_none(building_profile(d)),
        _profile_sql("ufs_con_accesorios", "ufs_con_accesorios = 0"),
    ),
    "q_a3_storage_only": Entry(
        lambda d: profile.storage_only(building_profile(d)),
        _profile_sql("ufs_con_baulera, ufs_con_cochera", "ufs_con_baulera > 0 AND ufs_con_cochera = 0"),
    ),
    "q_a4_parking_only": Entry(
        lambda d: profile.parking_only(building_profile(d)),
        _profile_sql("ufs_con_baulera, ufs_con_cochera", "ufs_con_cochera > 0 AND ufs_con_baulera = 0"),
    ),
    "q_table_counts": Entry(
        lambda d: profile.table_counts(d.tables()),
        answer(
            "consorcio uf accesoria persona prestador pago expensa detalle feriado",
            "\nUNION ALL\n".join(
                f"SELECT '{label}' AS tabla, count(*) AS filas FROM {name}"
                for label, name in {
                    "consorcio": "consorcio",
                    "unidad": "uf",
                    "accesoria": "accesoria",
                    "persona": "persona",
                    "prestador": "prestador",
                    "pago": "pago",
                    "expensa": "expensa",
                    "detalle": "detalle",
                    "feriado": "feriado",
                }.items()
            ),
        ),
    ),
    "q_holiday_check": Entry(
        lambda d: holidays.with_is_holiday(d.payments.select("idDePago", "fechaPago"), "fechaPago", d.holidays),
        answer(
            "pago feriado",
            """
SELECT idDePago, fechaPago, CASE WHEN fechaPago IN (SELECT fecha FROM feriado) THEN 1 ELSE 0 END AS es_feriado
FROM pago""",
        ),
    ),
}
