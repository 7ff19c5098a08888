"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from tools.check_oracles import database, difference
from workload import registry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name in registry.QUERIES}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, connection, name):
    _, problem = difference(entry_points.queries()[name](spark, SF_DIR), connection, ORACLES[name])
    assert problem is None


def test_flagship_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
