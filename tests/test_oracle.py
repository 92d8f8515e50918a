"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from workload.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, SQL[name]) == []


def test_entry_lists_them_all():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
