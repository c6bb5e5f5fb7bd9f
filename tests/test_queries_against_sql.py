"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import glob
import importlib
import os
from collections import Counter

import pandas as pd
import pytest

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
entry = importlib.import_module("__spark_entry__")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def bag(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = [round(x, 5) + 0.0 if isinstance(x, float) else x for x in df[c]]
    return Counter(map(repr, map(tuple, df.astype(object).to_numpy().tolist())))


def table_of(got):
    """Columns as Arrow gives them: NaN and NULL stay apart (a NULL becomes None)."""
    return pd.DataFrame({c: pd.Series(got.column(c).to_pylist(), dtype=object) for c in got.column_names})


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    got = table_of(entry.queries()[name](spark, DATA).toArrow())
    want = table_of(duck.execute(SQL[name]).to_arrow_table())
    assert sorted(got.columns) == sorted(want.columns)
    assert bag(got) == bag(want)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_others_run(spark, name):
    assert entry.queries()[name](spark, DATA).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
