"""Every registered query next to its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

ROOT = "/root/testdata/sf0.001"
QUERIES, TWINS = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    n, wrong = difference(spark, con, ROOT, name, QUERIES[name], TWINS.get(name))
    assert wrong == ""


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 3 and all(r["keywords"] for r in rows)
