"""Stored base tables: parquet folders, published together or not at all.

A publish writes folders with DataFrameWriter and then one small pointer file that names the
folder of every part of every table. A part is one month of a table stored by month, the rejects
of one origin, or a whole table. Appending rewrites the parts that the new rows fall into, so the
pointer holds one entry a part, however often a table was appended to. Readers follow the newest
pointer only: a failed job leaves the old state in place.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.functions.dates import month_column
from patio.schemas import TABLES, WAITING, table_schema
from patio.session import materialize

VERSION = "version"
WHOLE = ""
# Tables that jobs cut by a date range lie in one folder per month of that date.
STORED_BY_MONTH = {
    "pago": "fechaPago",
    "expensa": "periodo",
    "estado": "periodo",
    "detalle": "periodo",
    "factura": "periodo",
}


def folder_columns(name: str) -> dict[str, Column]:
    """The columns a table is stored by, the one that tells its parts apart first."""
    if name == "rechazo":
        return {"origen": F.col("origen")}
    if name not in STORED_BY_MONTH:
        return {}
    day = STORED_BY_MONTH[name]
    missing = F.raise_error(F.lit(f"{name}: {day} is missing")).cast("date")
    columns = {month_column(day): F.coalesce(F.trunc(day, "month"), missing)}
    if name == "pago":
        # Payments that wait for their unit lie apart, so that a unit change reads only these.
        columns[WAITING] = F.col("nroUnidadFuncional").isNull()
    return columns


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._read: int | None = None

    def begin(self) -> None:
        """Forget what was read before, so that the next publish rests on later reads only."""
        self._read = None

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _names(self, *parts: str) -> list[str]:
        folder = self._path(*parts)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def _pointers(self) -> list[str]:
        return [n for n in self._names("_published") if n.endswith(".json")]

    def _state(self, pointers: list[str]) -> dict:
        if self._read is None:
            self._read = len(pointers)
        if not pointers:
            return {"tables": {}, "batches": {}}
        text = self.spark.read.text(f"{self.root}/_published/{pointers[-1]}", wholetext=True)
        return json.loads(text.first()[0])

    def current(self) -> dict[str, dict[str, str]]:
        """The version of each part of each table.

        What was read first since the last publish of this store is what the next one must
        still find (see publish).
        """
        return self._state(self._pointers())["tables"]

    def last_batch(self, stream: str) -> int:
        """The newest batch of a stream that was published, -1 before the first."""
        return self._state(self._pointers())["batches"].get(stream, -1)

    def load(self, name: str) -> DataFrame:
        """The table with its declared columns and those it is stored by, from one scan."""
        schema = table_schema(name)
        folders = folder_columns(name)
        for column in folders:
            if column not in schema.names:
                schema = schema.add(column, "boolean" if column == WAITING else "date")
        parts = self.current().get(name)
        if not parts:
            return self.spark.createDataFrame([], schema)
        first = next(iter(folders), None)
        paths = [
            f"{self.root}/{name}/{VERSION}={version}" + (f"/{first}={part}" if part != WHOLE else "")
            for part, version in parts.items()
        ]
        names = list(schema.names)
        stored = self.spark.read.schema(schema.add(VERSION, "string")).option("basePath", f"{self.root}/{name}")
        return stored.parquet(*paths).select(*names)

    def _shaped(self, name: str, df: DataFrame) -> DataFrame:
        declared = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(name).fields])
        return declared.withColumns(folder_columns(name))

    def _write(self, name: str, rows: DataFrame) -> dict[str, str]:
        """The parts that hold rows, all under one new version."""
        version = uuid.uuid4().hex
        folders = list(folder_columns(name))
        if folders:
            # Rebalancing keeps a part in few files and splits one that is too large.
            rows = rows.hint("rebalance", *folders)
        writer = rows.write.mode("errorifexists")
        writer = writer.partitionBy(*folders) if folders else writer
        writer.parquet(f"{self.root}/{name}/{VERSION}={version}")
        if not folders:
            return {WHOLE: version}
        found = self._names(name, f"{VERSION}={version}")
        return {n.partition("=")[2]: version for n in found if n.startswith(f"{folders[0]}=")}

    def _appended(self, name: str, df: DataFrame, parts: dict[str, str]) -> dict[str, str]:
        """Parts of a table after new rows have come to those they fall into."""
        rows = materialize(self._shaped(name, df))
        old = self.load(name)
        folders = list(folder_columns(name))
        if folders:
            # At most one value a month of the history, or one an origin.
            touched = [r[0] for r in rows.select(folders[0]).distinct().collect()]
            if not touched:
                return parts
            old = old.filter(F.col(folders[0]).isin(touched))
        return {**parts, **self._write(name, old.unionByName(rows))}

    def publish(
        self,
        replace: dict[str, DataFrame] | None = None,
        append: dict[str, DataFrame] | None = None,
        replace_months: dict[str, tuple[DataFrame, list[dt.date]]] | None = None,
        batch: tuple[str, int] | None = None,
    ) -> None:
        """Replace tables, append to others and replace months of others, in one step.

        Folders already published stay as they are. It fails where another writer has published
        since this store first read a table for it. `batch` is the stream and number of the
        micro-batch that is thereby done.
        """
        replace_months = replace_months or {}
        unknown = {*(replace or {}), *(append or {}), *replace_months} - set(TABLES)
        if unknown:
            raise KeyError(f"no such table: {sorted(unknown)}")
        seen = self._pointers()
        state, read = self._state(seen), self._read
        if read != len(seen):
            self._read = None
            raise RuntimeError("another publish came first; run this one again")
        tables = state["tables"]
        for name, df in (replace or {}).items():
            tables[name] = self._write(name, self._shaped(name, df))
        for name, df in (append or {}).items():
            tables[name] = self._appended(name, df, tables.get(name, {}))
        for name, (df, months) in replace_months.items():
            gone = {str(m) for m in months}
            written = self._write(name, self._shaped(name, df))
            if not written.keys() <= gone:
                raise ValueError(f"{name}: rows of months that are not replaced: {sorted(written.keys() - gone)}")
            tables[name] = {p: v for p, v in tables.get(name, {}).items() if p not in gone} | written
        if batch:
            state["batches"][batch[0]] = batch[1]
        self._read = None
        self._point(state, len(seen))

    def overwrite(self, name: str, df: DataFrame | None = None) -> None:
        """Replace a table, with no rows when no frame is given."""
        empty = self.spark.createDataFrame([], table_schema(name))
        self.publish(replace={name: empty if df is None else df})

    def _point(self, state: dict, number: int) -> None:
        path = self._path("_published", f"{number:012d}.json")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        # Creating without overwrite fails when another writer took the number meanwhile.
        try:
            out = fs.create(path, False)
        except Py4JJavaError as taken:
            raise RuntimeError("another publish came first; run this one again") from taken
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
