"""Every registered query of the library against its SQL, and its schema's stability."""

import glob
import os

import duckdb
import pytest

from cantilena.oracle import SQL
from cantilena.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _plain(v):
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(map(_plain, r)) for r in df.collect()]
    if name not in SQL:
        assert rows or name in ("probable_segment_before",)
        return
    got = duck.execute(SQL[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    assert sorted(rows, key=str) == sorted((tuple(_plain(r[i]) for i in order) for r in got.fetchall()), key=str)
