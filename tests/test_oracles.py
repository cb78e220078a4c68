"""Every query with SQL must return the same rows as that SQL on another engine."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connection


@pytest.fixture(scope="module")
def con(sf_dir):
    pytest.importorskip("duckdb")
    return connection(sf_dir)


def test_every_oracle_names_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    assert compare(queries()[name](spark, sf_dir), con, oracle_sql()[name]) == ""
