"""Declared rules of the tables as jobs that return what breaks them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.functions.text import digits_only
from patio.operators.dedup import repeated_keys

REASON = "motivo"


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every rule, other rows with the first rule they break).

    A rule that is unknown (NULL) counts as broken.
    """
    reason = F.coalesce(
        *[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    )
    marked = df.withColumn(REASON, reason)
    return marked.filter(F.col(REASON).isNull()).drop(REASON), marked.filter(F.col(REASON).isNotNull())


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return repeated_keys(df.dropna(subset=list(keys)), keys)


def foreign_key_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose parent is missing; NULL is allowed."""
    known = parent.select(F.col(parent_column).alias("_parent"))
    return child.filter(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("_parent"), "left_anti"
    )


def check_violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows where the rule is false; unknown passes."""
    return df.filter(~rule)


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return split_valid(df, {f"{c} NULL": F.col(c).isNotNull() for c in columns})[1]


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    rules = {f"{c} > {n}": F.coalesce(F.length(c) <= n, F.lit(True)) for c, n in limits.items()}
    return split_valid(df, rules)[1]


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), value) for c, value in defaults.items()})


# The declared rules, per table.
PRIMARY_AND_UNIQUE: dict[str, list[tuple[str, ...]]] = {
    "consorcio": [("id",)],
    "persona": [("id",), ("dni",)],
    "prestador": [("id",)],
    "unidad": [("idUF",), ("idConsorcio", "numeroUnidad")],
    "accesoria": [("idUnidadFuncional",)],
    "pago": [("idDePago",)],
    "expensa": [("id",), ("idUF", "periodo")],
    "factura": [("numeroFactura",)],
    "feriado": [("fecha",)],
}

FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("prestador", "idConsorcio", "consorcio", "id"),
    ("unidad", "idConsorcio", "consorcio", "id"),
    ("accesoria", "idUnidadFuncional", "unidad", "idUF"),
    ("pago", "nroUnidadFuncional", "unidad", "idUF"),
    ("expensa", "idUF", "unidad", "idUF"),
    ("detalle", "idExpensa", "expensa", "id"),
    ("detalle", "idPrestadorServicio", "prestador", "id"),
    ("factura", "idExpensa", "expensa", "id"),
    ("estado", "idExpensa", "expensa", "id"),
]


# Columns that must have a value, and the longest text of a column.
REQUIRED: dict[str, tuple[str, ...]] = {
    "consorcio": ("id", "nombre", "domicilio", "cantidadUnidades", "m2totales"),
    "persona": ("id",),
    "prestador": ("id", "idConsorcio", "nombre"),
    "unidad": ("idUF", "idConsorcio", "numeroUnidad", "coeficiente", "m2_UF"),
    "accesoria": ("idUnidadFuncional", "m2_baulera", "m2_cochera"),
    "pago": ("idDePago", "fechaPago", "cbu", "monto"),
    "expensa": ("id", "idUF", "periodo", "montoTotal"),
    "detalle": ("idExpensa", "idPrestadorServicio", "importe"),
    "factura": ("numeroFactura", "idExpensa", "fechaEmision", "fechaVencimiento", "nroVencimiento"),
}
LENGTHS: dict[str, dict[str, int]] = {
    "consorcio": {"nombre": 100, "domicilio": 100},
    "persona": {"nombre": 100, "apellido": 100, "email": 100, "telefono": 20, "cbu_cvu": 30, "tipoTitularidad": 11},
    "prestador": {"nombre": 100, "tipoServicio": 100, "cuenta": 100},
    "unidad": {"departamento": 10, "cbu_cvu_actual": 30},
    "pago": {"cbu": 30},
    "expensa": {"modoEnvio": 50},
    "detalle": {"nroFactura": 50, "tipo": 50, "categoria": 50},
}


def table_checks(table: str) -> dict[str, Column]:
    """The value rules of a table, by name."""
    c = F.col
    return {
        "consorcio": {"m2totales >= 0": c("m2totales") >= 0},
        "persona": {"cbu_cvu digits": digits_only(c("cbu_cvu"))},
        "prestador": {"cuenta digits": digits_only(c("cuenta"))},
        "unidad": {
            "m2_UF > 0": c("m2_UF") > 0,
            "coeficiente >= 0": c("coeficiente") >= 0,
            "cbu_cvu_actual digits": digits_only(c("cbu_cvu_actual")),
        },
        "accesoria": {"m2_baulera >= 0": c("m2_baulera") >= 0, "m2_cochera >= 0": c("m2_cochera") >= 0},
        "expensa": {"montoTotal > 0": c("montoTotal") > 0},
        "factura": {"nroVencimiento > 0": c("nroVencimiento") > 0},
    }.get(table, {})


def broken_checks(df: DataFrame, table: str) -> DataFrame:
    """Rows that break a value rule of their table, with the first one broken."""
    passes = {k: F.coalesce(v, F.lit(True)) for k, v in table_checks(table).items()}
    return split_valid(df, passes)[1]


def broken_values(table: str) -> dict[str, Column]:
    """When a row breaks each declared rule on its own values; unknown passes a check."""
    bad = {name: ~rule for name, rule in table_checks(table).items()}
    bad |= {f"{c} NOT NULL": F.col(c).isNull() for c in REQUIRED.get(table, ())}
    return bad | {f"{c} <= {n}": F.length(c) > n for c, n in LENGTHS.get(table, {}).items()}


def row_rules(tables: dict[str, DataFrame], table: str) -> DataFrame | None:
    """One row per value rule and foreign key of a table, all counted in one scan of it.

    The key columns of the parents are joined to it from the left, each key once.
    """
    df, bad = tables[table], broken_values(table)
    for number, (child, column, parent, parent_column) in enumerate(FOREIGN_KEYS):
        if child != table or parent not in tables:
            continue
        known = tables[parent].select(F.col(parent_column).alias(f"_p{number}")).distinct()
        df = df.join(known, F.col(column) == F.col(f"_p{number}"), "left")
        bad[f"{column} -> {parent}"] = F.col(column).isNotNull() & F.col(f"_p{number}").isNull()
    if not bad:
        return None
    sums = df.agg(*[F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(bad.values())])
    named = [F.struct(F.lit(name).alias("regla"), F.col(f"_{i}").alias("violaciones")) for i, name in enumerate(bad)]
    rows = sums.select(F.explode(F.array(*named)).alias("r"))
    return rows.select(F.lit(table).alias("tabla"), "r.regla", "r.violaciones")


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared rule with the number of violations.

    Uniqueness needs its own grouping; everything else of a table comes from one scan.
    """
    parts = []
    for table, df in tables.items():
        for keys in PRIMARY_AND_UNIQUE.get(table, []):
            found = unique_violations(df, keys).agg(F.count(F.lit(1)).alias("violaciones"))
            parts.append(found.select(F.lit(table).alias("tabla"), F.lit("unique " + ", ".join(keys)).alias("regla"), "violaciones"))
        rules = row_rules(tables, table)
        if rules is not None:
            parts.append(rules)
    return reduce(DataFrame.unionByName, parts)
