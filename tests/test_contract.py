"""Every registered query that has SQL agrees with it."""

import duckdb
import pandas as pd
import pytest

from castellan.plans import contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if pd.api.types.is_scalar(v) and pd.isna(v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f"{float(v):.6f}"
    return str(pd.Timestamp(v)) if hasattr(v, "year") else str(v)


def rows(df):
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].values.tolist())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_agrees_with_sql(spark, con, name):
    got = contract.QUERIES[name](spark, SF).toPandas()
    if name in contract.ORACLES:
        want = con.sql(contract.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns)
