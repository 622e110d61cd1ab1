"""Sources, cleaning expressions and filters, over the whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.functions import dates, numbers, text
from patio.schemas import CONCEPTS, RAW_CHARGES, RAW_GROUPS, RAW_PERSONS, RAW_UNIT_ACCOUNTS, RAW_UNITS
from patio.sources import delimited, holidays, sheets
from patio.sources.charges_json import read_charges
from patio.sources.tables import TableStore
from patio.workload import raw
from patio.workload.answers import answer
from patio.workload.domain import Domain, padded
from patio.workload.entry import Entry


def _orders(d: Domain, *columns: Column) -> DataFrame:
    return d.read("orders").select(F.col("o_orderkey").alias("id"), *columns)


def _customers(d: Domain, *columns: Column) -> DataFrame:
    return d.read("customer").select(F.col("c_custkey").alias("id"), *columns)


def _round_trip(d: Domain, rows: DataFrame, kind: str, sep: str) -> DataFrame:
    """Write the rows as a raw file of that kind and read it with its reader."""
    path = d.scratch(kind)
    delimited.write_delimited(rows, path, sep)
    return delimited.read_delimited(d.spark, path, sep, rows.columns)


def _empty_as_null(df: DataFrame) -> DataFrame:
    """Blank cells and NULLs read alike, so compare them as NULL."""
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def csv_comma(d: Domain) -> DataFrame:
    return _empty_as_null(_round_trip(d, raw.payments(d), "payments", ","))


def csv_pipe(d: Domain) -> DataFrame:
    return _empty_as_null(_round_trip(d, raw.unit_accounts(d).select(*RAW_UNIT_ACCOUNTS), "unit_accounts", "|"))


def csv_semicolon(d: Domain) -> DataFrame:
    return _empty_as_null(_round_trip(d, raw.persons(d).select(*RAW_PERSONS), "persons", ";"))


def csv_tab(d: Domain) -> DataFrame:
    rows = _empty_as_null(_round_trip(d, raw.units(d).select(*RAW_UNITS), "units", "\t"))
    return rows.withColumnRenamed("Nombre del consorcio", "nombre_consorcio")


def sheet_header(d: Domain) -> DataFrame:
    path = d.scratch("sheet")
    delimited.write_delimited(raw.groups(d), path, ";")
    rows = sheets.read_sheet(d.spark, path, RAW_GROUPS, sep=";")
    return rows.toDF("consorcio", "nombre", "domicilio", "unidades", "m2")


def sheet_range(d: Domain) -> DataFrame:
    """A sheet with a title line, a header line and data from B3 on."""
    path = d.scratch("range")
    k = F.col("s_suppkey")
    title = d.spark.range(2).select(
        (F.col("id") + 1).cast("string").alias("fila"),
        *[F.lit("titulo").alias(c) for c in ("A", "B", "C", "D", "E")],
    )
    cells = d.read("supplier").select(
        (k + 3).cast("string").alias("fila"),
        F.lit("").alias("A"),
        F.concat(F.lit("servicio "), k % 7).alias("B"),
        F.col("s_name").alias("C"),
        F.concat(F.lit("Cuenta "), k).alias("D"),
        F.col("s_nationkey").cast("string").alias("E"),
    )
    delimited.write_delimited(cells.unionByName(title), path, ",", header=False)
    return sheets.read_sheet_range(d.spark, path, 3, LAST_SHEET_ROW, 2, 4)


def json_schema(d: Domain) -> DataFrame:
    """Known keys only; a key that is absent gives NULL."""
    parsed = F.from_json("props", "k bigint, `sin clave` string")
    return d.read("events").select(
        F.col("event_id").alias("id"),
        parsed["k"].alias("k"),
        parsed["sin clave"].alias("sin_clave"),
    )


def json_array(d: Domain) -> DataFrame:
    """Array files of at most RECORDS_IN_FILE records each, through the reader of the import."""
    path = d.scratch("arrays")
    k = F.col("s_suppkey")
    record = F.struct(
        F.struct(k.alias("oid")).alias("_id"),
        F.col("s_name").alias(RAW_CHARGES[0]),
        F.lit("Mayo ").alias("Mes"),
        F.when(k % 3 != 0, F.concat(k, F.lit(",50"))).alias(CONCEPTS[0]),
        F.format_number(F.col("s_acctbal"), 2).alias(CONCEPTS[-1]),
    )
    files = d.read("supplier").groupBy(F.floor(k / RECORDS_IN_FILE).alias("lote")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(record)), ","), F.lit("]")).alias("value")
    )
    files.write.partitionBy("lote").text(path)
    rows = read_charges(d.spark, path)
    return rows.select(
        F.col(f"`{RAW_CHARGES[0]}`").alias("nombre"),
        F.col("Mes").alias("mes"),
        F.col(f"`{CONCEPTS[0]}`").alias("primero"),
        F.col(f"`{CONCEPTS[1]}`").alias("segundo"),
        F.col(f"`{CONCEPTS[-1]}`").alias("ultimo"),
    )


def table_scan(d: Domain) -> DataFrame:
    store = TableStore(d.spark, d.scratch("store"))
    store.publish(replace={"pago": d.payments})
    return store.load("pago").select(*d.payments.columns)


def holiday_load(d: Domain) -> DataFrame:
    path = d.scratch("holidays")
    delimited.write_delimited(d.holidays, path, ",")
    return holidays.load_holidays(d.spark, path, 1998)


def concept_rows(d: Domain) -> DataFrame:
    lines = d.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.element_at(F.array(*[F.lit(c) for c in CONCEPTS]), F.col("l_linenumber")).alias("concepto"),
    )
    return lines.join(d.concept_map, "concepto").groupBy("concepto", "tipoServicio", "categoria").agg(
        F.count(F.lit(1)).alias("lineas")
    )


ODATE = "CAST(o_orderdate AS DATE)"
LAST_SHEET_ROW = 1 << 62
RECORDS_IN_FILE = 1000
AMOUNT = "CAST(o_totalprice AS DECIMAL(12,2))"
ACCOUNT = "lpad(CAST(o_custkey AS VARCHAR), 22, '0')"
PAY_VALUE = f"{AMOUNT} + v.mas"
VARIANTS = """JOIN (VALUES (0, 0), (1, 0), (1, 0), (2, 0), (2, 1)) v(tipo, mas)
  ON v.tipo = CASE WHEN o_orderkey % 31 = 6 THEN 1 WHEN o_orderkey % 29 = 4 THEN 2 ELSE 0 END"""
DATE_TEXT = f"""CASE o_orderkey % 3
  WHEN 0 THEN strftime(o_orderdate, '%-d/%-m/%Y')
  WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
GROUPED = "format('{:,.2f}', o_totalprice)"


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


def _month_name() -> Column:
    names = F.element_at(F.array(*[F.lit(m) for m in dates.MONTHS]), F.month("o_orderdate"))
    k = F.col("o_orderkey")
    return (
        F.when(k % 3 == 0, F.concat(F.initcap(names), F.lit(" ")))
        .when(k % 17 == 1, F.lit("setiembre"))
        .otherwise(names)
    )


QUERIES: dict[str, Entry] = {
    # ------------------------------------------------------------------------------- sources
    "src_json_schema": Entry(
        json_schema,
        "SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS sin_clave FROM events",
    ),
    "src_json_array": Entry(
        json_array,
        """
SELECT s_name AS nombre, 'Mayo ' AS mes, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey || ',50' END AS primero,
       CAST(NULL AS VARCHAR) AS segundo, format('{:,.2f}', s_acctbal) AS ultimo FROM supplier""",
    ),
    "src_csv_comma": Entry(
        csv_comma,
        f"""
SELECT CASE WHEN o_orderkey % 50 = 7 THEN 'x' ELSE ' ' END || o_orderkey AS "IdDePago",
       CASE WHEN o_orderkey % 41 = 5 THEN '2025-13-45' ELSE {DATE_TEXT} END AS "FechaTxt",
       CASE WHEN o_orderkey % 37 = 3 THEN '  '
            WHEN o_orderkey % 2 = 0 THEN ' ' || {ACCOUNT}[1:4] || chr(160) || {ACCOUNT}[5:]
            ELSE {ACCOUNT} END AS "CbuCvu",
       CASE WHEN o_orderkey % 43 = 11 THEN '1.234.56' ELSE ' $ ' || CAST({PAY_VALUE} AS DECIMAL(12,2)) END AS "ValorTxt"
FROM orders {VARIANTS}""",
    ),
    "src_csv_pipe": Entry(
        csv_pipe,
        """
SELECT CASE WHEN c_custkey % 17 = 3 THEN '00x1' WHEN c_custkey % 9 = 4 THEN ' '
            ELSE '"' || lpad(CAST(c_custkey + 7 AS VARCHAR), 20, '0')[1:4] || ' ' ||
                 lpad(CAST(c_custkey + 7 AS VARCHAR), 20, '0')[5:] || '-"' END AS cbu_uf,
       CASE WHEN c_custkey % 23 = 7 THEN 'nadie' ELSE '"' || lower(n_name) || '"' END AS "nombreConsorcio",
       ' ' || replace(format('{:,}', c_custkey), ',', '.') AS "nroUF", 'x' AS tipo,
       CASE WHEN v.mas = 1 THEN 'ZZ' WHEN c_custkey % 6 = 1 THEN ' ' ELSE 'D' || (c_custkey % 40) END AS departamento
FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN (VALUES (0, 0), (1, 0), (1, 1)) v(tipo, mas) ON v.tipo = CASE WHEN c_custkey % 19 = 6 THEN 1 ELSE 0 END""",
    ),
    "src_csv_semicolon": Entry(
        csv_semicolon,
        """
SELECT '"N ' || c_custkey || '" ' AS nombre,
       CASE WHEN c_custkey % 47 = 8 THEN '""' ELSE ' A ' || c_custkey END AS apellido,
       replace(format('{:,}', c_custkey + 10000000), ',', '.') || ' ' AS dni,
       CASE WHEN c_custkey % 8 = 2 THEN ' ' ELSE 'p ' || c_custkey || '@x.org' END AS email,
       CASE WHEN c_custkey % 13 = 4 THEN '+54' ELSE '11 ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS telefono,
       CASE WHEN c_custkey % 5 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 22, '0') END AS cbu_cvu,
       CASE WHEN c_custkey % 2 = 1 THEN ' "1" ' WHEN c_custkey % 4 = 0 THEN '0' END AS tipotitularidad
FROM customer JOIN (VALUES (0), (1), (1)) v(tipo) ON v.tipo = CASE WHEN c_custkey % 11 = 3 THEN 1 ELSE 0 END""",
    ),
    "src_csv_tab": Entry(
        csv_tab,
        """
SELECT CASE WHEN c_custkey % 23 = 7 THEN 'nadie' ELSE lower(n_name) || ' ' END AS nombre_consorcio,
       CASE WHEN c_custkey % 59 = 1 THEN 'x' ELSE CAST(c_custkey AS VARCHAR) END AS "nroUnidadFuncional",
       CASE WHEN c_custkey % 4 = 0 THEN 'pb' ELSE CAST(c_custkey % 9 AS VARCHAR) END AS "Piso",
       CASE WHEN c_custkey % 6 = 1 THEN ' ' ELSE 'D' || (c_custkey % 40) END AS departamento,
       CASE WHEN c_custkey % 7 = 3 THEN '100,5' ELSE (c_custkey % 40) || ',' || (c_custkey % 10) END AS coeficiente,
       CASE WHEN c_custkey % 61 = 2 THEN '0' WHEN c_custkey % 10 = 6 THEN 's/d'
            ELSE CAST(c_custkey % 80 + 15 AS VARCHAR) END AS m2_unidad_funcional,
       CASE WHEN c_custkey % 3 = 0 THEN ' si ' ELSE 'NO' END AS bauleras,
       CASE WHEN c_custkey % 5 = 0 THEN 'SI' END AS cochera,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 7 + 1 AS VARCHAR) END AS m2_baulera,
       CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey % 11 + 1 AS VARCHAR) ELSE '-' END AS m2_cochera
FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN (VALUES (0), (1), (1)) v(tipo) ON v.tipo = CASE WHEN c_custkey % 53 = 9 THEN 1 ELSE 0 END""",
    ),
    "src_sheet_header": Entry(
        sheet_header,
        """
SELECT CAST(s_suppkey AS VARCHAR) AS consorcio,
       CASE WHEN s_suppkey % 5 = 0 THEN lower(n_name) || '  ' ELSE ' ' || s_name END AS nombre,
       CASE WHEN s_suppkey % 17 = 2 THEN ' ' ELSE 'Av. ' || s_suppkey END AS domicilio,
       CASE WHEN s_suppkey % 11 = 3 THEN '0' ELSE CAST(s_suppkey % 90 + 5 AS VARCHAR) END AS unidades,
       replace(format('{:,}', s_suppkey % 5000 + 1000), ',', '.') AS m2
FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    ),
    "src_sheet_range": Entry(
        sheet_range,
        """
SELECT 'servicio ' || (s_suppkey % 7) AS "F1", s_name AS "F2", 'Cuenta ' || s_suppkey AS "F3",
       CAST(s_nationkey AS VARCHAR) AS "F4" FROM supplier""",
    ),
    "src_table_scan": Entry(
        table_scan,
        answer("pago", "SELECT * FROM pago"),
    ),
    "src_holidays": Entry(
        holiday_load, answer("feriado", "SELECT * FROM feriado WHERE year(fecha) = 1998")
    ),
    # --------------------------------------------------------------------------- expressions
    "expr_trim_null": Entry(
        lambda d: d.read("customer").select(
            F.col("c_custkey").alias("id"),
            text.trimmed(F.concat(F.lit("  "), F.col("c_name"), F.lit(text.NBSP + " "))).alias("recortado"),
            text.blank_to_null(F.when(F.col("c_acctbal") < 0, F.lit("   ")).otherwise(F.col("c_name"))).alias("texto"),
        ),
        """
SELECT c_custkey AS id, c_name || chr(160) AS recortado, CASE WHEN c_acctbal >= 0 THEN c_name END AS texto
FROM customer""",
    ),
    "expr_strip_chars": Entry(
        lambda d: _customers(
            d,
            text.strip_chars(
                F.concat(F.lit(' "'), "c_name", F.lit('".-,' + text.NBSP), "c_mktsegment"), '" .,-' + text.NBSP
            ).alias("limpio"),
        ),
        "SELECT c_custkey AS id, c_name || c_mktsegment AS limpio FROM customer",
    ),
    "expr_truncate": Entry(
        lambda d: _customers(d, text.truncate(F.col("c_name"), 12).alias("corto")),
        "SELECT c_custkey AS id, substr(c_name, 1, 12) AS corto FROM customer",
    ),
    "expr_try_int": Entry(
        lambda d: _orders(
            d,
            numbers.try_integer(
                F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.col("o_custkey")))
                .when(F.col("o_orderstatus") == "O", F.concat(F.col("o_custkey"), F.lit(".0")))
                .otherwise(F.col("o_orderpriority"))
            ).alias("entero"),
            numbers.try_integer((F.col("o_custkey") % 90000).cast("string"), "smallint").alias("corto"),
        ),
        """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS INTEGER) END AS entero,
       CASE WHEN o_custkey % 90000 <= 32767 THEN CAST(o_custkey % 90000 AS SMALLINT) END AS corto FROM orders""",
    ),
    "expr_try_decimal": Entry(
        lambda d: _orders(
            d,
            numbers.try_decimal(
                F.when(F.col("o_orderstatus") == "F", F.translate(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), ".", ","))
                .when(F.col("o_orderstatus") == "O", F.concat(F.lit("1."), F.col("o_totalprice").cast("decimal(12,2)").cast("string")))
                .otherwise(F.concat(F.col("o_custkey"), F.lit("e3"))),
                "decimal(12,2)",
            ).alias("importe"),
            numbers.try_decimal(F.concat(F.col("o_custkey") % 150, F.lit(",25")), "decimal(3,1)").alias("coeficiente"),
        ),
        f"""
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN {AMOUNT} END AS importe,
       CASE WHEN o_custkey % 150 < 100 THEN CAST(o_custkey % 150 + 0.3 AS DECIMAL(3,1)) END AS coeficiente
FROM orders""",
    ),
    "expr_multi_date": Entry(
        lambda d: _orders(
            d,
            dates.parse_date(
                F.when(F.col("o_orderkey") % 41 == 5, F.lit("2025-13-45")).otherwise(
                    raw.date_text(F.col("o_orderkey"), _day())
                )
            ).alias("fecha"),
        ),
        f"SELECT o_orderkey AS id, CASE WHEN o_orderkey % 41 <> 5 THEN {ODATE} END AS fecha FROM orders",
    ),
    "expr_amount_locale": Entry(
        lambda d: _orders(
            d, numbers.mixed_locale_amount(raw.amount_text(F.col("o_orderkey"), F.col("o_totalprice"))).alias("importe")
        ),
        f"SELECT o_orderkey AS id, {AMOUNT} AS importe FROM orders",
    ),
    "expr_month_name": Entry(
        lambda d: _orders(
            d,
            dates.month_number(_month_name()).alias("mes"),
            dates.period_of(F.year("o_orderdate"), dates.month_number(_month_name())).alias("periodo"),
        ),
        """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 17 <> 1 THEN CAST(month(o_orderdate) AS INTEGER) END AS mes,
       CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 17 <> 1 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS periodo
FROM orders""",
    ),
    "expr_account": Entry(
        lambda d: d.read("supplier").select(
            F.col("s_suppkey").alias("id"),
            numbers.account_number(
                F.when(F.col("s_acctbal") < 0, F.lit(" - "))
                .when(F.col("s_nationkey") < 5, F.concat(F.lit("9" * 16), padded(F.col("s_suppkey"), 10)))
                .otherwise(F.concat(F.lit(" CUENTA 00"), F.col("s_suppkey"), F.lit(".3 4")))
            ).alias("cuenta"),
        ),
        """
SELECT s_suppkey AS id, CASE WHEN s_acctbal >= 0 AND s_nationkey >= 5 THEN '00' || s_suppkey || '34' END AS cuenta
FROM supplier""",
    ),
    "pred_digits_only": Entry(
        lambda d: _orders(
            d,
            text.digits_only(
                F.when(F.col("o_orderstatus") == "F", padded(F.col("o_custkey"), 22))
                .when(F.col("o_orderstatus") == "O", F.lit(""))
                .when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority"))
            ).alias("solo_digitos"),
        ),
        """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus IN ('F', 'O') THEN TRUE
       WHEN o_orderpriority = '5-LOW' THEN FALSE END AS solo_digitos FROM orders""",
    ),
    "expr_flag": Entry(
        lambda d: _orders(
            d,
            text.yes_flag(
                F.when(F.col("o_orderstatus") == "F", F.lit(" si ")).when(F.col("o_orderstatus") == "O", F.lit("no"))
            ).alias("marca"),
        ),
        "SELECT o_orderkey AS id, o_orderstatus = 'F' AS marca FROM orders",
    ),
    "expr_code_label": Entry(
        lambda d: _orders(
            d,
            text.tenure_label(
                F.when(F.col("o_orderstatus") == "F", F.lit(' "1"')).when(F.col("o_orderstatus") == "O", F.lit("2"))
            ).alias("titularidad"),
        ),
        """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'Inquilino' ELSE 'Propietario' END AS titularidad
FROM orders""",
    ),
    "expr_floor": Entry(
        lambda d: _customers(
            d,
            numbers.floor_number(
                F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" Pb "))
                .when(F.col("c_mktsegment") == "MACHINERY", F.lit("alto"))
                .otherwise((F.col("c_nationkey")).cast("string"))
            ).alias("piso"),
        ),
        """
SELECT c_custkey AS id, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
       THEN CAST(c_nationkey AS SMALLINT) END AS piso FROM customer""",
    ),
    "expr_coalesce": Entry(
        lambda d: d.units.select("idUF", F.coalesce("cbu_cvu_actual", F.lit("sin cuenta")).alias("cuenta")),
        answer("uf", "SELECT idUF, coalesce(cbu_cvu_actual, 'sin cuenta') AS cuenta FROM uf"),
    ),
    "expr_concept_map": Entry(
        concept_rows,
        answer(
            "concepto",
            """
SELECT c.concepto, c.tipoServicio, c.categoria, count(*) AS lineas
FROM lineitem JOIN concepto c ON c.orden = l_linenumber - 1 GROUP BY 1, 2, 3""",
        ),
    ),
    "expr_month_key": Entry(
        lambda d: _orders(d, dates.month_key(_day()).alias("mes")),
        "SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') AS mes FROM orders",
    ),
    "expr_month_start": Entry(
        lambda d: _orders(d, dates.month_start(_day()).alias("inicio")),
        "SELECT o_orderkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS inicio FROM orders",
    ),
    "expr_month_end": Entry(
        lambda d: _orders(d, F.last_day(_day()).alias("fin")),
        "SELECT o_orderkey AS id, last_day(CAST(o_orderdate AS DATE)) AS fin FROM orders",
    ),
    "expr_date_add": Entry(
        lambda d: _orders(
            d,
            F.date_add(_day(), 10).alias("mas_dias"),
            F.add_months(_day(), 1).alias("mas_meses"),
            F.date_add(_day(), 7 * 3).alias("mas_semanas"),
        ),
        f"""
SELECT o_orderkey AS id, {ODATE} + 10 AS mas_dias, CAST({ODATE} + INTERVAL 1 MONTH AS DATE) AS mas_meses,
       {ODATE} + 21 AS mas_semanas FROM orders""",
    ),
    "expr_date_diff": Entry(
        lambda d: _orders(d, F.date_diff(F.last_day(_day()), _day()).alias("dias")),
        f"SELECT o_orderkey AS id, CAST(last_day({ODATE}) - {ODATE} AS INTEGER) AS dias FROM orders",
    ),
    # A Sunday counts for the week that starts the day after.
    "expr_week_start": Entry(
        lambda d: _orders(d, dates.week_start(_day()).alias("semana")),
        f"""
SELECT o_orderkey AS id, CASE WHEN dayofweek(o_orderdate) = 0 THEN {ODATE} + 1
       ELSE {ODATE} - CAST(dayofweek(o_orderdate) - 1 AS INTEGER) END AS semana FROM orders""",
    ),
    "expr_round": Entry(
        lambda d: d.read("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            numbers.money(F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)"))
            .cast("decimal(12,2)")
            .alias("impuesto"),
        ),
        """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS impuesto
FROM lineitem""",
    ),
    "expr_share": Entry(
        lambda d: _customers(
            d, numbers.percent_of(F.col("c_custkey") % 97, F.col("c_nationkey")).alias("porcentaje")
        ).withColumn("porcentaje", F.round("porcentaje", 6).cast("decimal(18,6)")),
        """
SELECT c_custkey AS id, CAST(CASE WHEN c_nationkey = 0 THEN 0
       ELSE ((c_custkey % 97) * 200000000 + c_nationkey) // (2 * c_nationkey) * 0.000001 END AS DECIMAL(18,6)) AS porcentaje
FROM customer""",
    ),
    "expr_sign_split": Entry(
        lambda d: _customers(
            d,
            numbers.positive_part(F.col("c_acctbal").cast("decimal(18,2)")).alias("deudor"),
            numbers.negative_part(F.col("c_acctbal").cast("decimal(18,2)")).alias("adelantado"),
        ),
        """
SELECT c_custkey AS id, CAST(CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS DECIMAL(18,2)) AS deudor,
       CAST(CASE WHEN c_acctbal < 0 THEN -c_acctbal ELSE 0 END AS DECIMAL(18,2)) AS adelantado FROM customer""",
    ),
    # ------------------------------------------------------------------------------- filters
    "flt_date_range": Entry(
        lambda d: dates.in_range(d.payments, "fechaPago", "1996-02-10", "1998-11-03"),
        answer("pago", "SELECT * FROM pago WHERE fechaPago >= DATE '1996-02-10' AND fechaPago < DATE '1998-11-04'"),
    ),
    "flt_optional_param": Entry(
        lambda d: _optional(d, None).unionByName(_optional(d, 7)),
        answer(
            "uf",
            """
SELECT 'todos' AS filtro, idConsorcio, count(*) AS unidades FROM uf GROUP BY idConsorcio
UNION ALL SELECT 'uno', idConsorcio, count(*) FROM uf WHERE idConsorcio = 7 GROUP BY idConsorcio""",
        ),
    ),
    "flt_cutoff": Entry(
        lambda d: d.payments.filter(F.col("fechaPago") <= F.lit("1998-06-30").cast("date")),
        answer("pago", "SELECT * FROM pago WHERE fechaPago <= DATE '1998-06-30'"),
    ),
}


def _optional(d: Domain, group_id: int | None) -> DataFrame:
    kept = d.units if group_id is None else d.units.filter(F.col("idConsorcio") == group_id)
    return kept.groupBy("idConsorcio").agg(F.count(F.lit(1)).alias("unidades")).select(
        F.lit("todos" if group_id is None else "uno").alias("filtro"), "idConsorcio", "unidades"
    )
