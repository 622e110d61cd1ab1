"""Raw text rows as they would arrive, rendered from the tables with realistic dirt.

The kind of dirt a row gets follows from its key; every row of the table is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.functions.dates import MONTHS
from patio.functions.text import NBSP
from patio.schemas import CONCEPTS, RAW_CHARGES
from patio.workload.domain import Domain, padded


def _copies(twice: Column, changed: Column | None = None) -> Column:
    """0 for each copy; a changed second copy is 1."""
    copies = F.when(twice, F.array(F.lit(0), F.lit(0)))
    if changed is not None:
        copies = copies.when(changed, F.array(F.lit(0), F.lit(1)))
    return F.explode(copies.otherwise(F.array(F.lit(0))))


def dotted(number: Column) -> Column:
    """Thousands marks, as in 1.281."""
    return F.translate(F.format_number(number, 0), ",", ".")


def date_text(key: Column, day: Column) -> Column:
    return (
        F.when(key % 3 == 0, F.date_format(day, "d/M/yyyy"))
        .when(key % 3 == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def amount_text(key: Column, amount: Column) -> Column:
    """One of the four shapes amounts come in."""
    grouped = F.format_number(amount, 2)
    return (
        F.when(key % 4 == 0, grouped)
        .when(key % 4 == 1, F.translate(grouped, ",.", ".,"))
        .when(key % 4 == 2, F.translate(grouped, ".", ","))
        .otherwise(amount.cast("decimal(12,2)").cast("string"))
    )


def payments(d: Domain) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    rows = d.read("orders").withColumn("_mas", _copies(k % 31 == 6, k % 29 == 4))
    value = (F.col("o_totalprice").cast("decimal(12,2)") + F.col("_mas")).cast("decimal(12,2)").cast("string")
    account = padded(F.col("o_custkey"), 22)
    return rows.select(
        F.when(k % 50 == 7, F.concat(F.lit("x"), k)).otherwise(F.concat(F.lit(" "), k)).alias("IdDePago"),
        F.when(k % 41 == 5, F.lit("2025-13-45")).otherwise(date_text(k, day)).alias("FechaTxt"),
        F.when(k % 37 == 3, F.lit("  "))
        .when(k % 2 == 0, F.concat(F.lit(" "), F.left(account, F.lit(4)), F.lit(NBSP), F.substring(account, 5, 18)))
        .otherwise(account)
        .alias("CbuCvu"),
        F.when(k % 43 == 11, F.lit("1.234.56"))
        .otherwise(F.concat(F.lit(" $ "), value))
        .alias("ValorTxt"),
    )


def groups(d: Domain) -> DataFrame:
    """One row per supplier: every fifth names an existing building in lower case."""
    k = F.col("s_suppkey")
    rows = d.read("supplier").join(
        d.groups.select(F.col("id").alias("s_nationkey"), "nombre"),
        "s_nationkey",
    )
    name = F.when(k % 5 == 0, F.concat(F.lower("nombre"), F.lit("  "))).otherwise(
        F.concat(F.lit(" "), F.col("s_name"))
    )
    return rows.select(
        k.cast("string").alias("Consorcio"),
        name.alias("Nombre del consorcio"),
        F.when(k % 17 == 2, F.lit(" ")).otherwise(F.concat(F.lit("Av. "), k)).alias("Domicilio"),
        F.when(k % 11 == 3, F.lit("0")).otherwise((k % 90 + 5).cast("string")).alias("Cant unidades funcionales"),
        dotted(k % 5000 + 1000).alias("m2 totales"),
    )


def providers(d: Domain) -> DataFrame:
    k = F.col("s_suppkey")
    rows = d.read("supplier").join(
        d.groups.select(F.col("id").alias("s_nationkey"), "nombre"), "s_nationkey"
    )
    account = (
        F.when(k % 4 == 0, F.concat(F.lit("Cuenta 00"), k, F.lit(".345")))
        .when(k % 4 == 1, F.lit("-"))
        .when(k % 4 == 2, F.concat(F.lit("9" * 16), padded(k, 10)))
        .otherwise(F.concat(F.lit(" "), k, F.lit(" 77 ")))
    )
    return rows.withColumn("_mas", _copies(k % 7 == 2)).select(
        F.when(k % 3 == 0, F.lit(" otro servicio "))
        .when(k % 19 == 4, F.lit(" "))
        .otherwise(F.concat(F.lit("SERVICIO "), k % 7))
        .alias("F1"),
        F.col("s_name").alias("F2"),
        account.alias("F3"),
        F.when(k % 13 == 5, F.lit("nadie")).otherwise(F.concat(F.lit(" "), F.lower("nombre"))).alias("F4"),
    )


def _customers(d: Domain) -> DataFrame:
    names = d.groups.select(F.col("id").alias("c_nationkey"), F.col("nombre").alias("_grupo"))
    return d.read("customer").join(names, "c_nationkey")


def unit_accounts(d: Domain) -> DataFrame:
    k = F.col("c_custkey")
    account = padded(k + 7, 20)
    rows = _customers(d).withColumn("_mas", _copies(F.lit(False), k % 19 == 6))
    return rows.select(
        F.when(k % 17 == 3, F.lit("00x1"))
        .when(k % 9 == 4, F.lit(" "))
        .otherwise(
            F.concat(F.lit('"'), F.left(account, F.lit(4)), F.lit(" "), F.substring(account, 5, 16), F.lit('-"'))
        )
        .alias("cbu_uf"),
        F.when(k % 23 == 7, F.lit("nadie")).otherwise(F.concat(F.lit('"'), F.lower("_grupo"), F.lit('"'))).alias(
            "nombreConsorcio"
        ),
        F.concat(F.lit(" "), dotted(k)).alias("nroUF"),
        F.lit("x").alias("tipo"),
        F.when(F.col("_mas") == 1, F.lit("ZZ")).when(k % 6 == 1, F.lit(" ")).otherwise(F.concat(F.lit("D"), k % 40)).alias(
            "departamento"
        ),
    )


def persons(d: Domain) -> DataFrame:
    k = F.col("c_custkey")
    rows = d.read("customer").withColumn("_mas", _copies(k % 11 == 3))
    return rows.select(
        F.concat(F.lit('"N '), k, F.lit('" ')).alias("nombre"),
        F.when(k % 47 == 8, F.lit('""')).otherwise(F.concat(F.lit(" A "), k)).alias("apellido"),
        F.concat(dotted(k + 10_000_000), F.lit(" ")).alias("dni"),
        F.when(k % 8 == 2, F.lit(" ")).otherwise(F.concat(F.lit("p "), k, F.lit("@x.org"))).alias("email"),
        F.when(k % 13 == 4, F.lit("+54")).otherwise(F.concat(F.lit("11 "), padded(k, 8))).alias("telefono"),
        F.when(k % 5 == 0, F.lit("")).otherwise(padded(k, 22)).alias("cbu_cvu"),
        F.when(k % 2 == 1, F.lit(' "1" ')).when(k % 4 == 0, F.lit("0")).alias("tipotitularidad"),
    )


def units(d: Domain) -> DataFrame:
    k = F.col("c_custkey")
    rows = _customers(d).withColumn("_mas", _copies(k % 53 == 9))
    return rows.select(
        F.when(k % 23 == 7, F.lit("nadie")).otherwise(F.concat(F.lower("_grupo"), F.lit(" "))).alias(
            "Nombre del consorcio"
        ),
        F.when(k % 59 == 1, F.lit("x")).otherwise(k.cast("string")).alias("nroUnidadFuncional"),
        F.when(k % 4 == 0, F.lit("pb")).otherwise((k % 9).cast("string")).alias("Piso"),
        F.when(k % 6 == 1, F.lit(" ")).otherwise(F.concat(F.lit("D"), k % 40)).alias("departamento"),
        F.when(k % 7 == 3, F.lit("100,5"))
        .otherwise(F.concat(k % 40, F.lit(","), k % 10))
        .alias("coeficiente"),
        F.when(k % 61 == 2, F.lit("0")).when(k % 10 == 6, F.lit("s/d")).otherwise((k % 80 + 15).cast("string")).alias(
            "m2_unidad_funcional"
        ),
        F.when(k % 3 == 0, F.lit(" si ")).otherwise(F.lit("NO")).alias("bauleras"),
        F.when(k % 5 == 0, F.lit("SI")).alias("cochera"),
        F.when(k % 3 == 0, (k % 7 + 1).cast("string")).otherwise(F.lit("")).alias("m2_baulera"),
        F.when(k % 5 == 0, (k % 11 + 1).cast("string")).otherwise(F.lit("-")).alias("m2_cochera"),
    )


def charge_amounts(d: Domain) -> DataFrame:
    """Per building and month, the largest order line of each line number as an amount."""
    months = d.read("orders").select(
        "o_orderkey", "o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("periodo")
    )
    # Lines shrink per order before they meet their order, and per building after it.
    per_line = [
        F.max(F.when(F.col("l_linenumber") == i, F.col("l_extendedprice").cast("decimal(12,2)"))).alias(c)
        for i, c in enumerate(CONCEPTS, 1)
    ]
    lines = d.read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*per_line)
    homes = d.read("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (
        months.join(lines, "o_orderkey")
        .join(homes, "o_custkey")
        .groupBy("c_nationkey", "periodo")
        .agg(*[F.max(f"`{c}`").alias(c) for c in CONCEPTS])
    )


def charge_records(d: Domain) -> DataFrame:
    """The raw monthly records as JSON text, with the year they are for."""
    names = d.groups.select(F.col("id").alias("c_nationkey"), F.col("nombre").alias("_grupo"))
    rows = charge_amounts(d).join(names, "c_nationkey")
    month = F.month("periodo")
    spanish = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month)
    values = {
        RAW_CHARGES[0]: F.concat(F.lower("_grupo"), F.lit(" ")),
        "Mes": F.concat(F.initcap(spanish), F.lit(" ")),
        **{c: amount_text(month + i, F.col(f"`{c}`")) for i, c in enumerate(CONCEPTS)},
    }
    record = F.struct(F.lit("x").alias("_id"), *[v.alias(name) for name, v in values.items()])
    return rows.select(F.year("periodo").alias("anio"), F.to_json(record).alias("json"))
