"""Every registered query against its SQL twin, at the smallest scale, and its plan."""

import pytest

import __spark_entry__ as entry
from tests.conftest import plan
from workload.check import compare, duck

SF = "/root/testdata/sf0.001"
# Training-data queries run Python by design and have their own tests.
OWN = entry._training_data()
QUERIES = {k: v for k, v in entry.queries().items() if k not in OWN[0]}
SQL = {k: v for k, v in entry.oracle_sql().items() if k not in OWN[1]}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text and "PythonUDF" not in text and "MapInPandas" not in text
    assert compare(df, con, SQL[name]) == ""
