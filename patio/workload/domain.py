"""The base tables of the data model, derived from the star schema's tables.

Customers stand for units and persons, nations for buildings, suppliers for providers, orders
for payments and order lines for charge lines.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.functions.dates import month_start
from patio.functions.keys import charge_id
from patio.functions.text import OWNER, TENANT
from patio.schemas import CONCEPT_MAP, CONCEPTS, MONEY, table_schema
from patio.session import shared_folder

# The months of the sample's payments, for SQL that must name its columns.
MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 8)]

# Service types a user would supply for the seven concepts.
CONCEPT_ROWS = [
    (name, f"servicio {i}", "EXTRAORDINARIO" if name == "GASTOS GENERALES" else "ORDINARIO")
    for i, name in enumerate(CONCEPTS)
]


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


class Domain:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A new path in the folder all executors share."""
        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    def empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], table_schema(name))

    @functools.cached_property
    def groups(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.read("nation").select(
            k.cast("bigint").alias("id"),
            F.col("n_name").alias("nombre"),
            F.concat(F.lit("Calle "), k).alias("domicilio"),
            (k + 10).alias("cantidadUnidades"),
            (k * 10 + 1000).alias("m2totales"),
        )

    @functools.cached_property
    def units(self) -> DataFrame:
        k = F.col("c_custkey")
        # Numbers ending in 2 share the account before theirs; numbers ending in 0 have none.
        account = F.when(k % 10 == 2, padded(k - 1, 22)).when(k % 10 != 0, padded(k, 22))
        return self.read("customer").select(
            k.alias("idUF"),
            F.col("c_nationkey").cast("bigint").alias("idConsorcio"),
            k.alias("numeroUnidad"),
            (k % 12).cast("smallint").alias("piso"),
            F.col("c_mktsegment").alias("departamento"),
            ((k % 50) * F.expr("0.1BD")).cast("decimal(3,1)").alias("coeficiente"),
            (k % 97 + 20).cast("int").alias("m2_UF"),
            account.alias("cbu_cvu_actual"),
        )

    @functools.cached_property
    def accessories(self) -> DataFrame:
        k, g = F.col("c_custkey"), F.col("c_nationkey")
        return self.read("customer").filter("c_mktsegment <> 'BUILDING'").select(
            k.alias("idUnidadFuncional"),
            ((g % 3 == 0) & (k % 5 == 0)).alias("cochera"),
            ((g % 2 == 0) & (k % 3 == 0)).alias("baulera"),
            (k % 7).cast("int").alias("m2_baulera"),
            (k % 13).cast("int").alias("m2_cochera"),
        )

    @functools.cached_property
    def payments(self) -> DataFrame:
        k = F.col("o_custkey")
        return self.read("orders").select(
            F.col("o_orderkey").alias("idDePago"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", k).alias("nroUnidadFuncional"),
            F.col("o_orderdate").cast("date").alias("fechaPago"),
            padded(k, 22).alias("cbu"),
            F.col("o_totalprice").cast(MONEY).alias("monto"),
        )

    @functools.cached_property
    def span(self) -> tuple[str, str]:
        """First and last day with a payment."""
        days = self.payments.agg(F.min("fechaPago"), F.max("fechaPago")).first()
        return str(days[0]), str(days[1])

    def _order_months(self) -> DataFrame:
        return self.read("orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("idUF"),
            month_start(F.col("o_orderdate").cast("date")).alias("periodo"),
        )

    @functools.cached_property
    def charges(self) -> DataFrame:
        lines = (
            self.read("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("_monto"))
        )
        monthly = (
            self._order_months()
            .join(lines, "o_orderkey")
            .groupBy("idUF", "periodo")
            .agg(F.sum("_monto").cast(MONEY).alias("montoTotal"))
        )
        return monthly.select(
            charge_id(F.col("idUF"), F.col("periodo")).alias("id"),
            "idUF",
            "periodo",
            "montoTotal",
            F.lit(None).cast("date").alias("fechaEnvio"),
            F.lit(None).cast("string").alias("modoEnvio"),
        )

    @functools.cached_property
    def details(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return (
            self.read("lineitem")
            .join(self._order_months(), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                charge_id(F.col("idUF"), F.col("periodo")).alias("idExpensa"),
                F.col("l_suppkey").alias("idPrestadorServicio"),
                F.col("l_extendedprice").cast(MONEY).alias("importe"),
                F.lit(None).cast("string").alias("nroFactura"),
                F.when(flag == "R", "Extraordinario").when(flag == "A", "Ordinario").alias("tipo"),
                F.when(flag == "R", "EXTRAORDINARIO").otherwise("ORDINARIO").alias("categoria"),
                "periodo",
            )
        )

    @functools.cached_property
    def providers(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.read("supplier").select(
            k.alias("id"),
            F.col("s_nationkey").cast("bigint").alias("idConsorcio"),
            F.col("s_name").alias("nombre"),
            F.concat(F.lit("servicio "), k % 7).alias("tipoServicio"),
            padded(k, 10).alias("cuenta"),
        )

    @functools.cached_property
    def persons(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.read("customer").select(
            k.alias("id"),
            F.col("c_name").alias("nombre"),
            F.col("c_mktsegment").alias("apellido"),
            (k + 10_000_000).alias("dni"),
            F.concat(F.lower("c_name"), F.lit("@mail.org")).alias("email"),
            padded(k, 10).alias("telefono"),
            padded(k, 22).alias("cbu_cvu"),
            F.when(k % 2 == 1, TENANT).otherwise(OWNER).alias("tipoTitularidad"),
        )

    @functools.cached_property
    def holidays(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        days = self.read("orders").select(day.alias("fecha")).distinct()
        return days.filter(F.dayofmonth("fecha").isin(1, 2, 9, 25)).select(
            "fecha",
            F.lit("inamovible").alias("tipo"),
            F.concat(F.lit("Feriado "), F.col("fecha").cast("string")).alias("nombre"),
        )

    @functools.cached_property
    def concept_map(self) -> DataFrame:
        return self.spark.createDataFrame(CONCEPT_ROWS, CONCEPT_MAP)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "consorcio": self.groups,
            "unidad": self.units,
            "accesoria": self.accessories,
            "persona": self.persons,
            "prestador": self.providers,
            "pago": self.payments,
            "expensa": self.charges,
            "detalle": self.details,
            "feriado": self.holidays,
        }
