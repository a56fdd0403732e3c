"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from workload import ORACLE, QUERIES
from workload.derived import PRICES

from .oracle import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_roll_back_takes_all_prices(con):
    """All prices before the rolled-back dates are in the query's SQL, not only some months."""
    (early,) = con.execute(f"SELECT count(*) FROM ({ORACLE['job_roll_back']}) WHERE trade_date < '1998-01-01'").fetchone()
    (all_early,) = con.execute(f"WITH {PRICES} SELECT count(*) FROM prices WHERE trade_date < DATE '1998-01-01'").fetchone()
    assert early == all_early > 0
