"""Every registered query against its DuckDB oracle on the small tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402
from stayledger.registry import ORACLES, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "transaction_id" and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    s = digest(df.columns, rows)
    o = digest(o_cols, res.fetchall())
    assert s[0] == o[0], (s[0], o[0])
    assert s[2] == o[2]
    assert s[1] == o[1]
