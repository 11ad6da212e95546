"""Every registered query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", list(queries()))
def test_query(spark, con, key):
    df = queries()[key](spark, SF)
    if key in SQL:
        assert difference(df, con, SQL[key]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
