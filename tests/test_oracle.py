"""Every query with SQL agrees with DuckDB on the smallest tables."""

import os
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from feedjobs.plans.queries import ORACLE, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the test tables")


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return ""
    if hasattr(v, "year"):
        return str(pd.Timestamp(v))
    if isinstance(v, (int, float, np.number)) and not isinstance(v, bool):
        return repr(round(float(v), 6))
    return str(v)


def rows(df):
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(got)
        return
    want = duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
