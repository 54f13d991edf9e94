"""Every registered query against its SQL, exactly, on whole tables."""

import pytest

import __spark_entry__ as entry_module
from catalogue import oracle, queries
from compare import differences, duck

QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duck(sf_dir)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    # The training-data queries are added to these; their tests are their own.
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
