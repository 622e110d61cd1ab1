"""Every registered query against its independent SQL answer."""

import pytest

import __spark_entry__ as driver
from patio.workload import registry
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ANSWERS = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_answer(spark, con, key):
    df = QUERIES[key](spark, SF_DIR)
    assert key in ANSWERS, "every query has an answer"
    assert difference(df, con, ANSWERS[key]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "semana_ini", "semana_fin", "total_semana", "promedio_periodo", "acumulado",
    ]
