"""Registered queries against their SQL, whole results, on the smallest benchmark tables."""

import pytest

import __spark_entry__ as entry_points
from ledgerline.queries import QUERIES, run
from verification.compare import difference, oracle_connection
from verification.oracle import expected_sql

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(DIRECTORY)


def test_every_query_has_sql():
    assert set(QUERIES) == set(expected_sql())
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["invoice_month", "plan_name", "paid_invoice_count", "mrr_eur"]
    assert rows.count() == 247


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    assert difference(run(name, spark, DIRECTORY), oracle, expected_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("broken_")])
def test_checks_on_the_faulty_build_find_something(oracle, name):
    assert oracle.sql(expected_sql()[name]).fetchall()
