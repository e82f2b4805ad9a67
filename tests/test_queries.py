"""Every registered query against its SQL equivalent, value by value."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, duck
from stratamart.workload.oracle import ORACLE
from stratamart.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_its_equivalent():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    count, problems = compare(QUERIES[name](spark, SF_DIR), connection, ORACLE[name])
    assert not problems
    assert count > 0


def test_entry(spark):
    assert entry(spark).count() > 0
