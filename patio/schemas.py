"""Declared columns of the base tables and of the raw files.

Identifiers are BIGINT and stored money is DECIMAL(18,2), wide enough for large tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,2)"
# Folder column of payments that have no unit yet.
WAITING = "espera"

# Table and column names users of the data model rely on.
TABLES: dict[str, str] = {
    "consorcio": "id bigint, nombre string, domicilio string, cantidadUnidades int, m2totales int",
    "persona": (
        "id bigint, nombre string, apellido string, dni bigint, email string, telefono string, "
        "cbu_cvu string, tipoTitularidad string"
    ),
    "persona_cifrada": (
        "id bigint, dni bigint, cbu_cvu string, tipoTitularidad string, nombre_encrypted binary, "
        "apellido_encrypted binary, email_encrypted binary, telefono_encrypted binary"
    ),
    "prestador": "id bigint, idConsorcio bigint, nombre string, tipoServicio string, cuenta string",
    "unidad": (
        "idUF bigint, idConsorcio bigint, numeroUnidad bigint, piso smallint, departamento string, "
        "coeficiente decimal(3,1), m2_UF int, cbu_cvu_actual string"
    ),
    "accesoria": (
        "idUnidadFuncional bigint, cochera boolean, baulera boolean, m2_baulera int, m2_cochera int"
    ),
    "pago": f"idDePago bigint, nroUnidadFuncional bigint, fechaPago date, cbu string, monto {MONEY}",
    "expensa": (
        f"id bigint, idUF bigint, periodo date, montoTotal {MONEY}, fechaEnvio date, modoEnvio string"
    ),
    "detalle": (
        f"idExpensa bigint, idPrestadorServicio bigint, importe {MONEY}, nroFactura string, "
        "tipo string, categoria string, periodo date"
    ),
    "factura": (
        "numeroFactura bigint, idExpensa bigint, fechaEmision date, fechaVencimiento date, nroVencimiento int, "
        f"interesPorMora {MONEY}, totalGastoOrdinario {MONEY}, totalGastoExtraordinario {MONEY}, periodo date"
    ),
    "estado": (
        f"idExpensa bigint, idUF bigint, periodo date, saldoAnterior {MONEY}, saldoNuevo {MONEY}, "
        f"saldoDeudor {MONEY}, saldoAdelantado {MONEY}, saldoTotal {MONEY}"
    ),
    # The latest statement of each unit.
    "saldo": f"idUF bigint, periodo date, saldoTotal {MONEY}",
    "feriado": "fecha date, tipo string, nombre string",
    "rechazo": "origen string, motivo string, fila string, copias bigint",
}

# The seven monthly amounts of a building, in file order.
CONCEPTS: tuple[str, ...] = (
    "BANCARIOS",
    "LIMPIEZA",
    "ADMINISTRACION",
    "SEGUROS",
    "GASTOS GENERALES",
    "SERVICIOS PUBLICOS-Agua",
    "SERVICIOS PUBLICOS-Luz",
)

# Columns of the raw inputs, all text.
RAW_CHARGES = ("Nombre del consorcio", "Mes", *CONCEPTS)
RAW_PAYMENTS = ("IdDePago", "FechaTxt", "CbuCvu", "ValorTxt")
RAW_GROUPS = (
    "Consorcio",
    "Nombre del consorcio",
    "Domicilio",
    "Cant unidades funcionales",
    "m2 totales",
)
RAW_PROVIDERS = ("F1", "F2", "F3", "F4")
RAW_UNITS = (
    "Nombre del consorcio",
    "nroUnidadFuncional",
    "Piso",
    "departamento",
    "coeficiente",
    "m2_unidad_funcional",
    "bauleras",
    "cochera",
    "m2_baulera",
    "m2_cochera",
)
RAW_UNIT_ACCOUNTS = ("cbu_uf", "nombreConsorcio", "nroUF", "tipo", "departamento")
RAW_PERSONS = ("nombre", "apellido", "dni", "email", "telefono", "cbu_cvu", "tipotitularidad")
CONCEPT_MAP = "concepto string, tipoServicio string, categoria string"


def text_schema(columns: tuple[str, ...] | list[str]) -> T.StructType:
    """Every column as text, so that no reader guesses or drops a value."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])
