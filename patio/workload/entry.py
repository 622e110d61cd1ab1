"""One registered query: what to run and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from patio.workload.domain import Domain


@dataclass(frozen=True)
class Entry:
    run: Callable[[Domain], DataFrame]
    sql: str | None = None
