"""Every registered query against its SQL, and the driver contract."""

import os

import pytest
from check_queries import compare

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for module in entry._MODULES:
        assert module.QUERIES.keys() == module.SQL.keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "o_orderkey" and not df.isEmpty()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, name):
    _, _, difference = compare(spark, SF_DIR, name)
    assert difference is None, difference
