"""Every registered query with SQL, compared value by value with DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


# Boosting with the full settings takes from minutes to hours on one machine; see the README.
LONG = {"benchmark_models", "champion_challenger", "cv_search", "oof_scores"}


@pytest.mark.parametrize("name", [
    pytest.param(n, marks=pytest.mark.skipif(n in LONG and not os.environ.get("FLEETLENS_LONG"), reason="set FLEETLENS_LONG"))
    for n in sorted(entry.oracle_sql())])
def test_query_equals_oracle(spark, connection, name):
    assert compare(spark, connection, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
