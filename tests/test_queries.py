"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check import connect, differences
from gleanrank.workload.oracle import ORACLE
from gleanrank.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert differences(got, sql.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10
