"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from custodia.workload import ORACLES, QUERIES
from tests.compare import check, connect


@pytest.fixture(scope="module")
def con(base):
    return connect(base)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, base, name):
    problem, _ = check(spark, con, base, name, QUERIES[name], ORACLES.get(name))
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
