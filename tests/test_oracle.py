"""Every registered query against its SQL on the smallest scale."""

import __spark_entry__ as entry_module
import pytest
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
ORACLE = entry_module.oracle_sql()
QUERIES = entry_module.registry.QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_entry_is_a_dataframe_with_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(entry_module.registry.ORACLE)
