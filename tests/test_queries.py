"""Every registered query beside its SQL on the smallest given tables."""

import os

import pytest
from compare import compare, tables

import __spark_entry__ as registry
from daybook.plans import queries as own

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", list(own.QUERIES))
def test_query_matches_sql(spark, db, name):
    good, note = compare(spark, db, SF_DIR, registry.queries()[name], registry.oracle_sql().get(name))
    assert good, note
    assert "types differ" not in note


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["account_id", "balance"] and df.count() > 0
