"""The driver's contract."""

import os

import pytest

import __spark_entry__ as entry


def test_contract():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and all(callable(f) for f in queries.values()) and all(sql.values())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["bucket", "seconds", "cum_seconds", "cum_share"] and df.count() > 0
