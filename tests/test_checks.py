"""Every check query against its SQL, on the smallest given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from checks import ORACLE, QUERIES
from checks.compare import compare, connect

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR).startswith("ok")


@needs_data
def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
