"""Every registered query against its DuckDB oracle on the smallest data set."""

import math
import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from barline.plans.registry import QUERIES
from oracle_sql import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "vwap" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _rows(sdf.columns, srows) == _rows(ocols, cur.fetchall())
