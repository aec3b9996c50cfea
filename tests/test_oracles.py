"""Every query with SQL gives the rows that an independent engine gives."""

import math

import duckdb
import numpy as np
import pytest

from drivegauge.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)].copy()
    for k in df.columns:
        if df[k].dtype == object:
            df[k] = df[k].map(lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else str(list(v)) if isinstance(v, (list, np.ndarray)) else str(v))
        elif not str(df[k].dtype).startswith("datetime"):
            df[k] = df[k].astype(float)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, con, name):
    got, want = rows(registry.queries()[name](spark, SF).toPandas()), rows(con.sql(registry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    for k in got.columns:
        a, b = got[k], want[k]
        assert ((a == b) | (a.isna() & b.isna())).all(), k


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows_only(spark, name):
    assert registry.queries()[name](spark, SF).limit(5).count() > 0
