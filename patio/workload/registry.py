"""Every registered query by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patio.workload import expression_queries, job_queries, operator_queries, report_queries
from patio.workload.domain import Domain
from patio.workload.entry import Entry


def entries() -> dict[str, Entry]:
    parts = (report_queries, job_queries, expression_queries, operator_queries)
    return {key: entry for part in parts for key, entry in part.QUERIES.items()}


def _bound(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: entry.run(Domain(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _bound(entry) for key, entry in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {key: entry.sql for key, entry in entries().items() if entry.sql}
