"""Queries of the package beside their SQL."""

import pytest

from custodia.llm.queries import ORACLES, QUERIES
from tests.compare import check, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, base, name):
    problem, rows = check(spark, connect(base), base, name, QUERIES[name], ORACLES[name])
    assert problem is None and rows
