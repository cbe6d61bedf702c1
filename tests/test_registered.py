"""Every registered query against its SQL over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from verification.compare import difference, oracle_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


def test_every_statement_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_of_tables_has_a_statement():
    from verification.cases import QUERIES

    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(contract.TEXT_SQL)))
def test_query_equals_its_sql(spark, oracle, name):
    assert difference(spark, oracle, name, FOLDER) is None
