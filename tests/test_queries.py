"""Every registered query against its SQL twin on the given tables."""

import pytest

import __spark_entry__ as contract
from lakeloom.queries import QUERIES, SQL
from tests.oracle import connect, oracle_rows, spark_rows



def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.fixture(scope="module")
def oracle(tables):
    db = connect(tables)
    yield db
    db.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, oracle, name):
    got = spark_rows(QUERIES[name](spark, tables))
    want = oracle_rows(oracle, SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "the query must return rows"


def test_entry(spark):
    assert contract.entry(spark).count() > 0
