"""Every query with an oracle must equal its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from riskwise.session import TABLES

from .conftest import SF_SMALL

SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert srows == drows


def test_every_query_is_registered_with_a_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["band", "n", "avg_p"]
    assert sum(r["n"] for r in df.collect()) > 0
