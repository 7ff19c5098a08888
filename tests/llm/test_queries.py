"""Registered queries against their SQL, on the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from tidemark.llm import registry
from tools.check_oracles import database, difference

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, connection, name):
    _, problem = difference(registry.QUERIES[name](spark, SF_DIR), connection, registry.ORACLES[name])
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_returns_every_row(spark, name):
    rows = registry.QUERIES[name](spark, SF_DIR).count()
    assert rows == registry.table(spark, SF_DIR, "pages" if "main_text" in name else "documents").count()


def test_pipeline_has_rows(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
