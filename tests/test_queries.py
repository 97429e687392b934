"""Every registered query against its SQL twin."""

import pytest
from compare import connect, oracle_rows, spark_rows

import __spark_entry__ as entry_module
from oracles import ORACLES
from rolecall.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, con, sf_dir):
    columns, expected = oracle_rows(con, ORACLES[name])
    got_columns, got = spark_rows(QUERIES[name](spark, sf_dir))
    assert got_columns == columns
    assert got == expected
    assert got or name == "mined_document_addresses"


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
