"""The registry of this package, and its queries against SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from stratalake.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

from .conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_registered():
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in queries()) == 1
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())
