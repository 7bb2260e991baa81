"""Every registered query has an oracle SQL and matches DuckDB exactly (after
9-significant-digit normalisation of floats) on the sf0.001 tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from pricelens.plans.registry import registry

SF = os.environ.get("PRICELENS_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
REGISTRY = registry()
assert all(sql is not None for _fn, sql in REGISTRY.values())
SQL = {name: sql for name, (_fn, sql) in REGISTRY.items() if sql is not None}
NAMES = sorted(REGISTRY)


def _v(v):
    import datetime as dt
    import numpy as np
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        s = v.isoformat(sep=" ")
        return s[:-9] if s.endswith(" 00:00:00") else s
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def rows_of(df):
    cols = sorted(df.columns)
    data = [[_v(x) for x in df[c].tolist()] for c in cols]
    rows = list(zip(*data)) if data else []
    rows.sort(key=lambda r: tuple((x is not None, str(x)) for x in r))
    return cols, rows


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "price_median" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    got = REGISTRY[name][0](spark, SF).toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)
