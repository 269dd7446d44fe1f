"""Every SQL-checkable registered query equals its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ORACLES = E.oracle_sql()


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "fraud_pct" in df.columns


def test_every_query_key_has_a_callable():
    q = E.queries()
    assert set(ORACLES) <= set(q)
    assert all(callable(f) for f in q.values())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_parity(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(ORACLES[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
