"""Driver contract and every SQL-checked query against DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from statweave.sources.tables import TABLE_NAMES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["stat", "direction", "rank", "c_custkey", "c_name", "value"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(None if (isinstance(v, float) and math.isnan(v)) else v for v in r))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = _norm(tuple(r[c] for c in cols) for r in sdf.collect())
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = _norm(tuple(r[i] for i in idx) for r in res.fetchall())
    assert got == exp
