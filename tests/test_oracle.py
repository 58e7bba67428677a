"""Every registered query against its SQL in DuckDB, over whole tables."""

import pytest

from check import compare, connect
from places import SMALL
from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, database, name):
    verdict = compare(spark, database, SMALL, name)
    assert verdict.startswith("ok" if name in oracle_sql() else "rows only"), verdict


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
