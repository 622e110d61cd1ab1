"""Every job by name over one set of stored tables: files in, reports out.

An import reads its file, runs the job and publishes all tables it changes in one step, with the
rejects it has not stored before (table `rechazo`). It returns its rejects. The order of imports is groups, providers, units, unit accounts, persons,
charges, payments.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.functions import dates, privacy
from patio.operators import joins, quality, upsert
from patio.plans import billing, imports, profile, reports
from patio.schemas import table_schema
from patio.session import materialize
from patio.sources import delimited, holidays, sheets, xml
from patio.sources.charges_json import read_charges
from patio.sources.tables import TableStore
from patio.streaming.jobs import linked_months

Day = dt.date | str
COUNTED = ("consorcio", "prestador", "unidad", "accesoria", "persona", "expensa", "detalle", "pago")


class Ledger:
    """`key` encrypts the personal columns at rest; without it they are stored as they are."""

    def __init__(self, spark: SparkSession, root: str, key: str | None = None):
        self.spark = spark
        self.store = TableStore(spark, root)
        self.key = key
        if key:
            privacy.hide_keys(spark)

    def table(self, name: str) -> DataFrame:
        if name == "persona" and self.key:
            stored = privacy.decrypt_columns(self.store.load("persona_cifrada"), self.key)
            plain = self.store.load("persona")
            return stored.select(*plain.columns)
        return self.store.load(name)

    # ------------------------------------------------------------------------------- imports

    def _reported(self, origin: str, rejects: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rejects not stored yet, all rejects of this import), both free of the input files."""
        found = materialize(rejects.withColumn("origen", F.lit(origin)))
        fresh = upsert.new_rows(self.table("rechazo"), found, ["origen", "motivo", "fila"])
        return upsert.shaped_like(self.table("rechazo"), fresh), found.select("motivo", "fila", "copias")

    def import_groups(self, path: str, reference_order: bool = False) -> DataFrame:
        self.store.begin()
        raw = sheets.read_sheet(self.spark, path)
        result = imports.import_groups(raw, self.table("consorcio"), reference_order)
        fresh, rejects = self._reported("consorcio", result.rejects)
        self.store.publish(replace={"consorcio": result.table}, append={"rechazo": fresh})
        return rejects

    def import_providers(
        self, path: str, first_row: int = 3, last_row: int | None = None, first_col: int = 2
    ) -> DataFrame:
        self.store.begin()
        raw = sheets.read_sheet_range(self.spark, path, first_row, last_row, first_col, 4)
        result = imports.import_providers(raw, self.table("consorcio"), self.table("prestador"))
        fresh, rejects = self._reported("prestador", result.rejects)
        self.store.publish(replace={"prestador": result.table}, append={"rechazo": fresh})
        return rejects

    def import_units(self, path: str) -> DataFrame:
        self.store.begin()
        raw = delimited.read_raw(self.spark, "units", path)
        result = imports.import_units(
            raw, self.table("consorcio"), self.table("unidad"), self.table("accesoria")
        )
        fresh, rejects = self._reported("unidad", result.rejects)
        self._publish_units({"unidad": result.units, "accesoria": result.accessories}, result.changed, fresh)
        return rejects

    def import_unit_accounts(self, path: str) -> DataFrame:
        self.store.begin()
        raw = delimited.read_raw(self.spark, "unit_accounts", path)
        result = imports.import_unit_accounts(raw, self.table("consorcio"), self.table("unidad"))
        fresh, rejects = self._reported("cuenta", result.rejects)
        self._publish_units({"unidad": result.units}, result.changed, fresh)
        return rejects

    def _publish_units(self, tables: dict[str, DataFrame], changed: DataFrame, rejects: DataFrame) -> None:
        """Changed units and the payments they tie appear together."""
        months = linked_months(self.store, materialize(changed))
        self.store.publish(replace=tables, append={"rechazo": rejects}, replace_months=months)

    def import_persons(self, path: str) -> DataFrame:
        self.store.begin()
        raw = delimited.read_raw(self.spark, "persons", path)
        name = "persona_cifrada" if self.key else "persona"
        stored = self.store.load(name)
        if self.key:
            privacy.assert_key(stored, self.key)
            result = imports.import_persons(raw, stored, lambda rows: privacy.encrypt_columns(rows, self.key))
        else:
            result = imports.import_persons(raw, stored)
        fresh, rejects = self._reported("persona", result.rejects)
        self.store.publish(replace={name: result.table}, append={"rechazo": fresh})
        return rejects

    def import_charges(
        self, path: str, concept_map: DataFrame, year: int, one_record_per_line: bool = False
    ) -> DataFrame:
        self.store.begin()
        result = imports.import_charges(
            read_charges(self.spark, path, one_record_per_line),
            self.table("consorcio"),
            self.table("unidad"),
            self.table("accesoria"),
            self.table("prestador"),
            concept_map,
            dates.in_range(self.table("expensa"), "periodo", f"{year}-01-01", f"{year}-12-31"),
            year,
        )
        fresh, rejects = self._reported("expensa", result.rejects)
        self.store.publish(append={"expensa": result.charges, "detalle": result.details, "rechazo": fresh})
        return rejects

    def import_payments(self, path: str) -> DataFrame:
        self.store.begin()
        raw = delimited.read_raw(self.spark, "payments", path)
        result = imports.import_payments(raw, self.table("unidad"), self.table("pago"))
        fresh, rejects = self._reported("pago", result.rejects)
        self.store.publish(append={"pago": result.payments, "rechazo": fresh})
        return rejects

    def load_holidays(self, path: str, year: int) -> None:
        self.store.begin()
        self.store.publish(replace={"feriado": holidays.load_holidays(self.spark, path, year)})

    # ------------------------------------------------------------------------------- billing

    def bill_month(self, year: int, month: int, issue_date: Day, skip_weekends: bool = False) -> None:
        """Add invoices and statements and set the month's send date, in one step."""
        self.store.begin()
        names = ("expensa", "detalle", "pago", "factura", "estado", "feriado")
        first = dates.month_bounds(year, month)[0]
        balances = self.table("saldo")
        # Months billed out of order look back through the statements themselves.
        in_order = balances.filter(F.col("periodo") > F.lit(str(first)).cast("date")).isEmpty()
        before = balances.filter(F.col("periodo") < F.lit(str(first)).cast("date"))
        bill = billing.bill_month(
            *[self.table(n) for n in names], year, month, issue_date, skip_weekends, before if in_order else None
        )
        statements = materialize(bill.statements)
        self.store.publish(
            replace={"saldo": billing.latest_balances(balances, statements)},
            append={"factura": bill.invoices, "estado": statements},
            replace_months={"expensa": (bill.charges, [first])},
        )

    def bill_history(self) -> DataFrame:
        """Statements of all months at once, as billing every month in order gives."""
        return billing.bill_history(self.table("expensa"), self.table("pago"))

    def reset_billing(self) -> None:
        self.store.begin()
        none = {name: self.spark.createDataFrame([], table_schema(name)) for name in ("factura", "estado", "saldo")}
        self.store.publish(replace=none)

    # ------------------------------------------------------------------------------- reports

    def weekly_cashflow(self, first: Day, last: Day, group_id: int | None = None) -> DataFrame:
        return reports.weekly_cashflow(self.table("pago"), self.table("unidad"), first, last, group_id)

    def month_by_apartment(self, first: Day, last: Day, group_id: int | None = None) -> DataFrame:
        tables = [self.table(n) for n in ("pago", "unidad", "consorcio")]
        return reports.month_by_apartment(*tables, first, last, group_id)

    def month_by_apartment_xml(self, path: str, first: Day, last: Day, group_id: int | None = None) -> None:
        rows = reports.month_by_apartment_xml(self.month_by_apartment(first, last, group_id))
        xml.write_xml(rows, path, reports.ROOT_MONTHS)

    def by_origin(
        self, first: Day, last: Day, group_id: int | None = None, origin_col: str = "tipo"
    ) -> DataFrame:
        tables = [self.table(n) for n in ("expensa", "detalle", "unidad")]
        return reports.by_origin(*tables, first, last, group_id, origin_col)

    def top_months(self, first: Day, last: Day, group_id: int | None = None, n: int = 5) -> DataFrame:
        tables = [self.table(t) for t in ("pago", "expensa", "detalle", "unidad")]
        return reports.top_months(*tables, first, last, group_id, n)

    def top_debtors(
        self, cutoff: Day, group_id: int | None = None, n: int = 3, one_row_per_person: bool = False
    ) -> DataFrame:
        tables = [self.table(t) for t in ("persona", "unidad", "pago", "expensa")]
        return reports.top_debtors(*tables, cutoff, group_id, n, one_row_per_person)

    def payment_gaps(self, first: Day, last: Day, group_id: int | None = None, marks: bool = False) -> DataFrame:
        tables = [self.table(n) for n in ("pago", "unidad", "consorcio")]
        return reports.payment_gaps(*tables, first, last, group_id, marks)

    def payment_gaps_nested(
        self, first: Day, last: Day, group_id: int | None = None, chunk: int = reports.CHUNK
    ) -> DataFrame:
        tables = [self.table(n) for n in ("pago", "unidad", "consorcio")]
        return reports.payment_gaps_nested(*tables, first, last, group_id, chunk)

    def payment_gaps_xml(
        self, path: str, first: Day, last: Day, group_id: int | None = None, siblings: bool = True
    ) -> None:
        lines = reports.payment_gaps_xml(self.payment_gaps(first, last, group_id, marks=True), siblings)
        xml.write_xml(xml.in_document_order(lines), path, reports.ROOT_PAYMENTS)

    def building_profile(self) -> DataFrame:
        return profile.building_profile(*[self.table(n) for n in ("consorcio", "unidad", "accesoria")])

    def buildings_with_both(self) -> DataFrame:
        return profile.with_both(self.building_profile())

    def buildings_with_none(self) -> DataFrame:
        return profile.with_none(self.building_profile())

    def buildings_with_storage_only(self) -> DataFrame:
        return profile.storage_only(self.building_profile())

    def buildings_with_parking_only(self) -> DataFrame:
        return profile.parking_only(self.building_profile())

    def shared_accounts(self) -> DataFrame:
        """Accounts that several units hold, with the lowest unit, which gets their payments."""
        return joins.account_owner(self.table("unidad")).filter("unidades > 1")

    def counts(self) -> DataFrame:
        return profile.table_counts({name: self.table(name) for name in COUNTED})

    def is_holiday(self, day: Day) -> bool:
        return not self.table("feriado").filter(F.col("fecha") == F.lit(str(day)).cast("date")).isEmpty()

    def rule_violations(self) -> DataFrame:
        names = (*COUNTED, "factura", "estado", "feriado")
        return quality.summary({name: self.table(name) for name in names})
