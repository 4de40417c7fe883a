"""Every registered query runs on the smallest scale and equals its SQL oracle (DuckDB)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import TABLES, digest, rows_of  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry(spark):
    df = entry(spark)
    assert df.count() >= 0 and "source_table" in df.columns


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF)
    srows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(key)
    if sql is None:
        assert len(srows) > 0
        return
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = rows_of(dcols, cur.fetchall())
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows) == digest(drows)
