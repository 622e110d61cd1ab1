"""Single operators over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patio.functions import dates
from patio.functions.keys import match_key
from patio.functions.text import is_extraordinary
from patio.operators import dedup, joins, quality, upsert
from patio.plans import billing, imports, reports
from patio.workload import raw
from patio.workload.answers import answer
from patio.workload.domain import Domain
from patio.workload.entry import Entry
from patio.workload.job_queries import stored_payments, stored_units


def person_changes(d: Domain) -> DataFrame:
    """New phones, missing for some, for known persons and for persons not stored yet."""
    lost = F.col("apellido") == "BUILDING"
    return d.persons.select(
        "id",
        F.when(F.col("apellido") == "MACHINERY", F.col("dni") + 50_000_000_000).otherwise(F.col("dni")).alias("dni"),
        F.upper("nombre").alias("nombre"),
        F.when(~lost, F.concat(F.lit("9"), F.col("telefono"))).alias("telefono"),
    )


PERSON_CHANGES = """
cambios AS (
  SELECT id, CASE WHEN apellido = 'MACHINERY' THEN dni + 50000000000 ELSE dni END AS dni, upper(nombre) AS nombre,
         CASE WHEN apellido <> 'BUILDING' THEN '9' || telefono END AS telefono FROM persona)"""


def _person_answer(value: str) -> str:
    return answer(
        "persona",
        f"""
WITH {PERSON_CHANGES}
SELECT p.id, coalesce(c.nombre, p.nombre) AS nombre, p.apellido, p.dni, p.email, {value} AS telefono, p.cbu_cvu,
       p.tipoTitularidad
FROM persona p LEFT JOIN cambios c USING (dni)
UNION ALL
SELECT id, nombre, NULL, dni, NULL, telefono, NULL, 'Propietario' FROM cambios
WHERE dni NOT IN (SELECT dni FROM persona)""",
    )


def _upsert_persons(d: Domain, policy: str) -> DataFrame:
    return upsert.upsert(
        d.persons,
        person_changes(d),
        ["dni"],
        policy,
        columns=["nombre", "telefono"],
        defaults={"tipoTitularidad": F.lit("Propietario")},
    )


def room_changes(d: Domain) -> DataFrame:
    """Extra rooms for every unit, so that units without an accessory row get one."""
    return d.units.select(
        F.col("idUF").alias("idUnidadFuncional"),
        (F.col("piso") > 6).alias("cochera"),
        F.when(F.col("departamento") != "FURNITURE", F.col("piso") > 3).alias("baulera"),
        F.col("piso").cast("int").alias("m2_baulera"),
        F.lit(0).alias("m2_cochera"),
    )


def asof(d: Domain) -> DataFrame:
    """Each payment with the unit's latest charge of an earlier day."""
    paid = d.payments.select("idDePago", F.col("nroUnidadFuncional").alias("idUF"), F.col("fechaPago").alias("dia"))
    charged = d.charges.select("idUF", F.col("periodo").alias("dia"), "montoTotal", "periodo")
    found = joins.asof_before(paid.filter("idUF IS NOT NULL"), charged, "idUF", "dia", ["periodo", "montoTotal"])
    return found.select("idDePago", "prev_periodo", "prev_montoTotal")


def two_aggs(d: Domain) -> DataFrame:
    paid = joins.sum_or_zero(d.units.select("idUF"), d.payments, "idUF", "nroUnidadFuncional", "monto", "pagado")
    both = joins.sum_or_zero(paid, d.charges, "idUF", "idUF", "montoTotal", "cobrado")
    return both.select(*[F.col(c).cast("decimal(28,2)").alias(c) if c != "idUF" else F.col(c) for c in both.columns])


def monthly_income(d: Domain) -> DataFrame:
    return d.payments.groupBy(dates.month_start(F.col("fechaPago")).alias("mes")).agg(
        F.sum("monto").alias("total")
    )


def total_average(d: Domain) -> DataFrame:
    every = Window.partitionBy()
    return monthly_income(d).select(
        "mes", "total", F.avg("total").over(every).cast("decimal(18,2)").alias("promedio")
    )


def running(d: Domain) -> DataFrame:
    so_far = Window.orderBy("mes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly_income(d).select("mes", "total", F.sum("total").over(so_far).alias("acumulado"))


def months_of_group(d: Domain) -> DataFrame:
    """Months with income per building as one ordered text, at most one entry per month."""
    months = (
        d.payments.filter("nroUnidadFuncional IS NOT NULL")
        .select(F.col("nroUnidadFuncional").alias("idUF"), dates.month_key(F.col("fechaPago")).alias("mes"))
        .distinct()
        .join(d.units.select("idUF", "idConsorcio"), "idUF")
        .select("idConsorcio", "mes")
        .distinct()
    )
    return months.groupBy("idConsorcio").agg(
        F.expr("listagg(mes, ',') WITHIN GROUP (ORDER BY mes)").alias("meses")
    )


def not_null(d: Domain) -> DataFrame:
    missing = quality.not_null_violations(d.units, ["cbu_cvu_actual"])
    long = quality.length_violations(d.units, {"departamento": 8})
    return missing.unionByName(long).select("idUF", "motivo")


def inner(d: Domain) -> DataFrame:
    named = d.units.join(d.groups.select(F.col("id").alias("idConsorcio"), "nombre"), "idConsorcio")
    return d.payments.join(named, F.col("nroUnidadFuncional") == F.col("idUF")).select(
        "idDePago", "idUF", "nombre", "monto"
    )


def multi_key(d: Domain) -> DataFrame:
    paid = d.payments.filter("nroUnidadFuncional IS NOT NULL").groupBy(
        F.col("nroUnidadFuncional").alias("idUF"), dates.month_start(F.col("fechaPago")).alias("periodo")
    ).agg(F.sum("monto").alias("pagado"))
    return d.charges.select("idUF", "periodo", "montoTotal").join(paid, ["idUF", "periodo"])


def clean_key(d: Domain) -> DataFrame:
    dirty = d.read("customer").select(
        F.col("c_custkey").alias("idUF"), F.concat(F.lit("nation_"), F.col("c_nationkey"), F.lit("  ")).alias("sucio")
    )
    known = d.groups.select(F.col("id").alias("idConsorcio"), "nombre")
    return dirty.join(known, match_key(F.col("sucio")) == match_key(F.col("nombre"))).select(
        "idUF", "idConsorcio", "nombre"
    )


def merge_source(d: Domain) -> DataFrame:
    rows = joins.group_by_name(imports.clean_units(raw.units(d)), F.col("consorcio"), d.groups)
    good = quality.split_valid(rows, imports.unit_rules())[0]
    return dedup.repeated_keys(good, ["idConsorcio", "numeroUnidad"])


def dirty_tables(d: Domain) -> dict[str, DataFrame]:
    """Tables with every kind of fault: units without number or too long, payments of no unit."""
    k = F.col("numeroUnidad")
    units = d.units.withColumns(
        {
            "departamento": F.when(k % 9 == 1, F.lit("departamento 12")).otherwise(F.col("departamento")),
            "coeficiente": F.when(k % 11 == 2, F.lit(None)).otherwise(F.col("coeficiente")),
        }
    )
    payments = d.payments.withColumn(
        "nroUnidadFuncional", F.when(F.col("idDePago") % 13 == 3, F.lit(-1)).otherwise(F.col("nroUnidadFuncional"))
    )
    return {"unidad": units, "pago": payments.unionByName(payments.where("idDePago % 17 = 4"))}


# Violations by rule; a rule that nothing breaks counts 0.
SUMMARY = answer(
    "uf pago",
    """
WITH u AS (
  SELECT * REPLACE (CASE WHEN numeroUnidad % 9 = 1 THEN 'departamento 12' ELSE departamento END AS departamento,
                    CASE WHEN numeroUnidad % 11 = 2 THEN NULL ELSE coeficiente END AS coeficiente) FROM uf),
p AS (
  SELECT * REPLACE (CASE WHEN idDePago % 13 = 3 THEN -1 ELSE nroUnidadFuncional END AS nroUnidadFuncional)
  FROM pago, range(CASE WHEN idDePago % 17 = 4 THEN 2 ELSE 1 END) r(copia))
SELECT v.tabla, v.regla, CAST(v.violaciones AS BIGINT) AS violaciones FROM (
  SELECT 'unidad' AS tabla, regla, violaciones FROM (SELECT
    sum(1) - count(DISTINCT idUF) AS "unique idUF",
    sum(1) - count(DISTINCT (idConsorcio, numeroUnidad)) AS "unique idConsorcio, numeroUnidad",
    count_if(m2_UF <= 0) AS "m2_UF > 0", count_if(coeficiente < 0) AS "coeficiente >= 0",
    count_if(regexp_matches(cbu_cvu_actual, '[^0-9]')) AS "cbu_cvu_actual digits",
    count_if(idUF IS NULL) AS "idUF NOT NULL", count_if(idConsorcio IS NULL) AS "idConsorcio NOT NULL",
    count_if(numeroUnidad IS NULL) AS "numeroUnidad NOT NULL", count_if(coeficiente IS NULL) AS "coeficiente NOT NULL",
    count_if(m2_UF IS NULL) AS "m2_UF NOT NULL", count_if(length(departamento) > 10) AS "departamento <= 10",
    count_if(length(cbu_cvu_actual) > 30) AS "cbu_cvu_actual <= 30" FROM u)
  UNPIVOT (violaciones FOR regla IN (COLUMNS(*)))
  UNION ALL
  SELECT 'pago', regla, violaciones FROM (SELECT
    sum(1) - count(DISTINCT idDePago) AS "unique idDePago",
    count_if(nroUnidadFuncional NOT IN (SELECT idUF FROM u)) AS "nroUnidadFuncional -> unidad",
    count_if(idDePago IS NULL) AS "idDePago NOT NULL", count_if(fechaPago IS NULL) AS "fechaPago NOT NULL",
    count_if(cbu IS NULL) AS "cbu NOT NULL", count_if(monto IS NULL) AS "monto NOT NULL",
    count_if(length(cbu) > 30) AS "cbu <= 30" FROM p)
  UNPIVOT (violaciones FOR regla IN (COLUMNS(*)))) v""",
)

QUERIES: dict[str, Entry] = {
    # -------------------------------------------------------------------------------- writes
    "w_insert_new": Entry(
        lambda d: upsert.insert_new(stored_payments(d), d.payments, ["idDePago"])[1],
        answer("pago", "SELECT * FROM pago"),
    ),
    "w_insert_returning": Entry(
        lambda d: upsert.insert_new(stored_payments(d), d.payments, ["idDePago"])[0],
        answer("pago", "SELECT p.* FROM pago p JOIN orders ON o_orderkey = idDePago WHERE o_orderstatus <> 'F'"),
    ),
    "w_upsert_overwrite": Entry(
        lambda d: _upsert_persons(d, upsert.OVERWRITE),
        _person_answer("CASE WHEN c.dni IS NULL THEN p.telefono ELSE c.telefono END"),
    ),
    "w_upsert_coalesce": Entry(
        lambda d: _upsert_persons(d, upsert.COALESCE), _person_answer("coalesce(c.telefono, p.telefono)")
    ),
    "w_merge_overwrite": Entry(
        lambda d: upsert.upsert(d.accessories, room_changes(d), ["idUnidadFuncional"]),
        answer(
            "uf",
            """
SELECT idUF AS idUnidadFuncional, piso > 6 AS cochera, CASE WHEN departamento <> 'FURNITURE' THEN piso > 3 END AS baulera,
       CAST(piso AS INTEGER) AS m2_baulera, 0 AS m2_cochera FROM uf""",
        ),
    ),
    "w_update_fill_null": Entry(
        lambda d: upsert.fill_null_from(
            d.units.withColumnRenamed("cbu_cvu_actual", "cbu"),
            d.persons.select(F.col("id").alias("idUF"), F.col("cbu_cvu").alias("cuenta")),
            ["idUF"],
            "cbu",
            "cuenta",
        ).select("idUF", "cbu"),
        answer("uf persona", "SELECT idUF, coalesce(cbu_cvu_actual, cbu_cvu) AS cbu FROM uf JOIN persona ON id = idUF"),
    ),
    "dq_merge_source_unique": Entry(
        merge_source,
        """
SELECT CAST(c_nationkey AS BIGINT) AS idConsorcio, c_custkey AS numeroUnidad, CAST(2 AS BIGINT) AS cantidad
FROM customer
WHERE c_custkey % 53 = 9 AND c_custkey % 23 <> 7 AND c_custkey % 59 <> 1 AND c_custkey % 61 <> 2""",
    ),
    # --------------------------------------------------------------------------------- joins
    "join_inner": Entry(
        inner,
        answer(
            "pago uf consorcio",
            """
SELECT idDePago, idUF, nombre, monto FROM pago JOIN uf ON nroUnidadFuncional = idUF
JOIN consorcio c ON c.id = idConsorcio""",
        ),
    ),
    "join_multi_key": Entry(
        multi_key,
        answer(
            "expensa pagos_mes",
            "SELECT idUF, periodo, montoTotal, pagos AS pagado FROM expensa JOIN pagos_mes USING (idUF, periodo)",
        ),
    ),
    "join_left": Entry(
        lambda d: d.units.join(d.accessories, F.col("idUF") == F.col("idUnidadFuncional"), "left").select(
            "idUF", "baulera", "cochera", "m2_baulera"
        ),
        answer(
            "uf accesoria",
            "SELECT idUF, baulera, cochera, m2_baulera FROM uf LEFT JOIN accesoria ON idUnidadFuncional = idUF",
        ),
    ),
    "join_anti": Entry(
        lambda d: d.units.join(
            d.accessories.select(F.col("idUnidadFuncional").alias("idUF")), "idUF", "left_anti"
        ).select("idUF", "departamento"),
        answer(
            "uf accesoria",
            "SELECT idUF, departamento FROM uf WHERE NOT EXISTS (SELECT 1 FROM accesoria WHERE idUnidadFuncional = idUF)",
        ),
    ),
    "join_asof": Entry(
        asof,
        answer(
            "pago expensa",
            """
SELECT p.idDePago, e.periodo AS prev_periodo, e.montoTotal AS prev_montoTotal
FROM (SELECT * FROM pago WHERE nroUnidadFuncional IS NOT NULL) p
ASOF LEFT JOIN expensa e ON e.idUF = p.nroUnidadFuncional AND e.periodo < p.fechaPago""",
        ),
    ),
    "join_scalar_agg": Entry(
        lambda d: joins.sum_or_zero(
            d.units.select("idUF"), d.payments, "idUF", "nroUnidadFuncional", "monto", "pagado"
        ).select("idUF", F.col("pagado").cast("decimal(28,2)").alias("pagado")),
        answer(
            "uf pago",
            """
SELECT idUF, CAST(coalesce((SELECT sum(monto) FROM pago WHERE nroUnidadFuncional = idUF), 0) AS DECIMAL(28,2)) AS pagado
FROM uf""",
        ),
    ),
    "join_clean_key": Entry(
        clean_key,
        answer("uf consorcio", "SELECT idUF, idConsorcio, nombre FROM uf JOIN consorcio c ON c.id = idConsorcio"),
    ),
    "join_next_business_day": Entry(
        lambda d: joins.with_next_free_day(
            d.payments.select("idDePago", "fechaPago"), "fechaPago", d.holidays, "habil"
        ),
        answer(
            "pago feriado",
            """
WITH dias AS (
  SELECT fechaPago, min(fechaPago + CAST(i AS INTEGER)) AS habil FROM (SELECT DISTINCT fechaPago FROM pago), range(11) t(i)
  WHERE fechaPago + CAST(i AS INTEGER) NOT IN (SELECT fecha FROM feriado) GROUP BY fechaPago)
SELECT idDePago, fechaPago, habil FROM pago LEFT JOIN dias USING (fechaPago)""",
        ),
    ),
    "join_account": Entry(
        lambda d: d.payments.join(joins.account_owner(d.units), "cbu", "left").select("idDePago", "idUF", "unidades"),
        answer("pago titular", "SELECT idDePago, idUF, unidades FROM pago LEFT JOIN titular USING (cbu)"),
    ),
    "join_two_aggs": Entry(
        two_aggs,
        answer(
            "uf pago expensa",
            """
WITH p AS (SELECT nroUnidadFuncional AS idUF, sum(monto) AS t FROM pago GROUP BY 1),
e AS (SELECT idUF, sum(montoTotal) AS t FROM expensa GROUP BY 1)
SELECT idUF, CAST(coalesce(p.t, 0) AS DECIMAL(28,2)) AS pagado, CAST(coalesce(e.t, 0) AS DECIMAL(28,2)) AS cobrado
FROM uf LEFT JOIN p USING (idUF) LEFT JOIN e USING (idUF)""",
        ),
    ),
    "reshape_unpivot": Entry(
        lambda d: imports.by_concept(raw.charge_amounts(d)),
        answer(
            "monto concepto",
            """
SELECT CAST(idConsorcio AS INTEGER) AS c_nationkey, periodo, concepto, monto AS importe
FROM monto JOIN concepto USING (orden) WHERE monto > 0""",
        ),
    ),
    # -------------------------------------------------------------------------- aggregations
    "agg_sum": Entry(
        lambda d: d.details.groupBy("idPrestadorServicio", "categoria").agg(F.sum("importe").alias("total")),
        answer("detalle", "SELECT idPrestadorServicio, categoria, sum(importe) AS total FROM detalle GROUP BY 1, 2"),
    ),
    "agg_month_sum": Entry(
        monthly_income,
        answer("pago", "SELECT CAST(date_trunc('month', fechaPago) AS DATE) AS mes, sum(monto) AS total FROM pago GROUP BY 1"),
    ),
    # Units left without lines: the ordinary sum is NULL and the extraordinary one 0.
    "agg_conditional_sum": Entry(
        lambda d: billing.new_invoices(
            d.charges,
            d.details.filter("tipo IS NOT NULL"),
            d.charges.limit(0).select(F.col("id").alias("idExpensa")),
            d.span[1],
        ).select("idExpensa", "totalGastoOrdinario", "totalGastoExtraordinario"),
        answer(
            "expensa detalle",
            """
WITH grupo AS (
  SELECT idExpensa, categoria = 'EXTRAORDINARIO' AS extra, sum(importe) AS total
  FROM detalle WHERE tipo IS NOT NULL GROUP BY 1, 2),
dos AS (SELECT idExpensa, sum(total) FILTER (NOT extra) AS comun, sum(total) FILTER (extra) AS extra FROM grupo GROUP BY 1)
SELECT id AS idExpensa, CAST(CASE WHEN dos.idExpensa IS NOT NULL THEN coalesce(comun, 0) END AS DECIMAL(18,2)) AS totalGastoOrdinario,
       CAST(coalesce(extra, 0) AS DECIMAL(18,2)) AS totalGastoExtraordinario
FROM expensa LEFT JOIN dos ON dos.idExpensa = id""",
        ),
    ),
    "agg_count_distinct": Entry(
        lambda d: d.payments.groupBy(dates.month_start(F.col("fechaPago")).alias("mes")).agg(
            F.count_distinct("nroUnidadFuncional").alias("unidades"), F.count_distinct("cbu").alias("cuentas")
        ),
        answer(
            "pago",
            """
SELECT CAST(date_trunc('month', fechaPago) AS DATE) AS mes, count(DISTINCT nroUnidadFuncional) AS unidades,
       count(DISTINCT cbu) AS cuentas FROM pago GROUP BY 1""",
        ),
    ),
    "agg_count": Entry(
        lambda d: d.payments.agg(
            F.count(F.lit(1)).alias("pagos"), F.count_if(F.col("nroUnidadFuncional").isNull()).alias("sin_unidad")
        ),
        answer("pago", "SELECT count(*) AS pagos, count(*) FILTER (WHERE nroUnidadFuncional IS NULL) AS sin_unidad FROM pago"),
    ),
    "agg_having": Entry(
        lambda d: d.details.groupBy("idPrestadorServicio")
        .agg(
            F.sum(F.when(is_extraordinary(F.col("tipo")), F.col("importe")).otherwise(F.lit(0))).alias("extra"),
            F.count(F.lit(1)).alias("lineas"),
        )
        .filter("extra > 7000000 AND lineas > 590"),
        answer(
            "detalle",
            """
SELECT idPrestadorServicio, sum(CASE WHEN tipo = 'Extraordinario' THEN importe ELSE 0 END) AS extra, count(*) AS lineas
FROM detalle GROUP BY 1
HAVING sum(CASE WHEN tipo = 'Extraordinario' THEN importe ELSE 0 END) > 7000000 AND count(*) > 590""",
        ),
    ),
    "agg_area": Entry(
        lambda d: imports.unit_areas(d.units, d.accessories),
        answer("area", "SELECT idUF, idConsorcio, CAST(m2 AS BIGINT) AS m2 FROM area"),
    ),
    "agg_string": Entry(
        months_of_group,
        answer(
            "pago uf",
            """
SELECT idConsorcio, string_agg(mes, ',' ORDER BY mes) AS meses
FROM (SELECT DISTINCT idConsorcio, strftime(fechaPago, '%Y-%m') AS mes FROM pago JOIN uf ON idUF = nroUnidadFuncional)
GROUP BY 1""",
        ),
    ),
    "agg_dups": Entry(
        lambda d: dedup.repeated_keys(d.payments, ["cbu", "fechaPago"]),
        answer("pago", "SELECT cbu, fechaPago, count(*) AS cantidad FROM pago GROUP BY 1, 2 HAVING count(*) > 1"),
    ),
    # ------------------------------------------------------------------------------- windows
    "win_running_sum": Entry(
        running,
        answer(
            "pago",
            """
WITH m AS (SELECT CAST(date_trunc('month', fechaPago) AS DATE) AS mes, sum(monto) AS total FROM pago GROUP BY 1)
SELECT mes, total, CAST(sum(total) OVER (ORDER BY mes) AS DECIMAL(38,2)) AS acumulado FROM m""",
        ),
    ),
    "win_total_avg": Entry(
        total_average,
        answer(
            "pago",
            """
WITH m AS (SELECT CAST(date_trunc('month', fechaPago) AS DATE) AS mes, sum(monto) AS total FROM pago GROUP BY 1)
SELECT mes, total, CAST(sum(total) OVER () / count(*) OVER () AS DECIMAL(18,2)) AS promedio FROM m""",
        ),
    ),
    "win_lead_gap": Entry(
        lambda d: reports.payment_days(d.payments, *d.span).select("idUF", "fechaPago", "pagos", "dias"),
        answer(
            "pago",
            """
WITH d AS (SELECT nroUnidadFuncional AS idUF, fechaPago, count(*) AS pagos FROM pago
           WHERE nroUnidadFuncional IS NOT NULL GROUP BY 1, 2)
SELECT *, CAST(lead(fechaPago) OVER (PARTITION BY idUF ORDER BY fechaPago) - fechaPago AS INTEGER) AS dias FROM d""",
        ),
    ),
    "win_dedup_first": Entry(
        lambda d: dedup.keep_one(d.payments, ["cbu"]),
        answer(
            "pago",
            """
SELECT * FROM pago
QUALIFY row_number() OVER (PARTITION BY cbu ORDER BY idDePago, nroUnidadFuncional, fechaPago, monto) = 1""",
        ),
    ),
    # ------------------------------------------------------------- sort, limit, distinct, sets
    "sort_multi": Entry(
        lambda d: d.payments.orderBy(F.asc("fechaPago"), F.desc("monto"), F.asc("idDePago")),
        answer("pago", "SELECT * FROM pago ORDER BY fechaPago, monto DESC, idDePago"),
    ),
    "topk_fixed": Entry(
        lambda d: monthly_income(d).orderBy(F.desc("total"), F.desc("mes")).limit(5),
        answer(
            "pago",
            """
SELECT CAST(date_trunc('month', fechaPago) AS DATE) AS mes, sum(monto) AS total FROM pago GROUP BY 1
ORDER BY total DESC, mes DESC LIMIT 5""",
        ),
    ),
    "topk_param": Entry(
        lambda d: d.payments.groupBy("cbu").agg(F.sum("monto").alias("total")).orderBy(F.desc("total"), "cbu").limit(12),
        answer("pago", "SELECT cbu, sum(monto) AS total FROM pago GROUP BY 1 ORDER BY total DESC, cbu LIMIT 12"),
    ),
    "distinct_rows": Entry(
        lambda d: d.payments.select("nroUnidadFuncional", dates.month_key(F.col("fechaPago")).alias("mes")).distinct(),
        answer("pago", "SELECT DISTINCT nroUnidadFuncional, strftime(fechaPago, '%Y-%m') AS mes FROM pago"),
    ),
    "dedup_drop_all": Entry(
        lambda d: dedup.drop_repeated(imports.clean_persons(raw.persons(d)).select("dni", "nombre", "email"), ["dni"]),
        """
SELECT c_custkey + 10000000 AS dni, 'N ' || c_custkey AS nombre,
       CASE WHEN c_custkey % 8 <> 2 THEN 'p' || c_custkey || '@x.org' END AS email
FROM customer WHERE c_custkey % 11 <> 3""",
    ),
    # ------------------------------------------------------------------------------- quality
    "dq_unique": Entry(
        lambda d: quality.unique_violations(d.units, ["cbu_cvu_actual"]),
        answer("titular", "SELECT cbu AS cbu_cvu_actual, unidades AS cantidad FROM titular WHERE unidades > 1"),
    ),
    "dq_foreign_key": Entry(
        lambda d: quality.foreign_key_violations(d.payments, "nroUnidadFuncional", stored_units(d), "idUF").select(
            "idDePago", "nroUnidadFuncional"
        ),
        answer(
            "pago uf",
            "SELECT idDePago, nroUnidadFuncional FROM pago JOIN uf ON idUF = nroUnidadFuncional WHERE departamento = 'MACHINERY'",
        ),
    ),
    "dq_check": Entry(
        lambda d: quality.check_violations(imports.clean_units(raw.units(d)), F.col("m2_UF") > 0).select(
            "numeroUnidad", "m2_UF"
        ),
        """
SELECT CASE WHEN c_custkey % 59 <> 1 THEN c_custkey END AS numeroUnidad, 0 AS m2_UF FROM customer
JOIN (VALUES (0), (1), (1)) v(tipo) ON v.tipo = CASE WHEN c_custkey % 53 = 9 THEN 1 ELSE 0 END
WHERE c_custkey % 61 = 2""",
    ),
    "dq_not_null": Entry(
        not_null,
        answer(
            "uf",
            """
SELECT idUF, 'cbu_cvu_actual NULL' AS motivo FROM uf WHERE cbu_cvu_actual IS NULL
UNION ALL SELECT idUF, 'departamento > 8' FROM uf WHERE length(departamento) > 8""",
        ),
    ),
    "dq_summary": Entry(lambda d: quality.summary(dirty_tables(d)), SUMMARY),
    "dq_default": Entry(
        lambda d: quality.with_defaults(
            d.units.join(d.accessories, F.col("idUF") == F.col("idUnidadFuncional"), "left").select(
                "idUF", "baulera", "m2_baulera"
            ),
            {"baulera": F.lit(False), "m2_baulera": F.lit(0)},
        ),
        answer(
            "uf accesoria",
            """
SELECT idUF, coalesce(baulera, FALSE) AS baulera, coalesce(m2_baulera, 0) AS m2_baulera
FROM uf LEFT JOIN accesoria ON idUnidadFuncional = idUF""",
        ),
    ),
}
