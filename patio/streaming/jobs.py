"""Incremental ingest of payment files and of unit changes.

Each micro-batch runs the batch job and publishes in one step, together with its number. A batch
that Spark repeats after a failure is known by that number and does nothing. Where the progress of
a stream itself is lost, files come again under new numbers and still change nothing: known
payment ids are skipped and linked payments do not move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from patio.functions.dates import month_column, month_start
from patio.operators.upsert import new_rows, shaped_like
from patio.plans.imports import import_payments
from patio.plans.linking import link_payments, newly_linked
from patio.schemas import RAW_PAYMENTS, text_schema
from patio.session import materialize
from patio.sources.delimited import READ_OPTIONS
from patio.sources.tables import STORED_BY_MONTH, TableStore

CHANGES = "idUF bigint, cbu_cvu_actual string"


def ingest_payments(
    spark: SparkSession, landing: str, store: TableStore, checkpoint: str, sep: str = ","
) -> StreamingQuery:
    """Import every payment file of the landing folder not seen yet, then stop."""
    files = (
        spark.readStream.options(**READ_OPTIONS)
        .option("sep", sep)
        .option("header", True)
        .schema(text_schema(RAW_PAYMENTS))
        .csv(landing)
    )

    def import_batch(batch: DataFrame, number: int) -> None:
        store.begin()
        if number <= store.last_batch(checkpoint):
            return
        found = import_payments(batch, store.load("unidad"), store.load("pago"))
        stored = store.load("rechazo")
        rejects = materialize(found.rejects.withColumn("origen", F.lit("pago")))
        fresh = new_rows(stored, rejects, ["origen", "motivo", "fila"])
        store.publish(append={"pago": found.payments, "rechazo": shaped_like(stored, fresh)}, batch=(checkpoint, number))

    return (
        files.writeStream.foreachBatch(import_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def linked_months(store: TableStore, changed: DataFrame) -> dict[str, tuple[DataFrame, list]]:
    """The months of payments in which waiting ones get their unit, ready to be published."""
    payments = store.load("pago")
    linked = newly_linked(payments, changed)
    day = STORED_BY_MONTH["pago"]
    # One value per month of the history at most.
    months = [r[0] for r in linked.select(month_start(F.col(day))).distinct().collect()]
    if not months:
        return {}
    touched = payments.filter(F.col(month_column(day)).isin(months))
    return {"pago": (link_payments(touched, changed), months)}


def link_batch(store: TableStore, changed: DataFrame, batch: tuple[str, int] | None = None) -> None:
    """Tie waiting payments and rewrite only the months that have some."""
    store.begin()
    if batch and batch[1] <= store.last_batch(batch[0]):
        return
    months = linked_months(store, changed)
    if months or batch:
        store.publish(replace_months=months, batch=batch)


def link_unit_changes(
    spark: SparkSession, changes: str, store: TableStore, checkpoint: str
) -> StreamingQuery:
    """Follow a folder of unit changes (parquet) and tie waiting payments, then stop."""
    stream = spark.readStream.schema(CHANGES).parquet(changes)

    def on_batch(batch: DataFrame, number: int) -> None:
        link_batch(store, materialize(batch.select("idUF", "cbu_cvu_actual").distinct()), (checkpoint, number))

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
