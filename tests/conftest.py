import pytest

from patio.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "patio-tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__session__timeZone="UTC",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """A frame of a base table from rows given as dicts; absent columns are NULL."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from patio.schemas import table_schema

    def make(name, *rows):
        schema = table_schema(name)
        typed = []
        for row in rows:
            unknown = set(row) - set(schema.names)
            assert not unknown, unknown
            typed.append(tuple(None if row.get(n) is None else str(row[n]) for n in schema.names))
        text = spark.createDataFrame(typed, ", ".join(f"`{n}` string" for n in schema.names))
        return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    make.money = lambda x: Decimal(str(x)).quantize(Decimal("0.01"))
    return make


@pytest.fixture
def raw(spark):
    """A frame of raw text columns."""

    def make(columns, *rows):
        return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{c}` string" for c in columns))

    return make
