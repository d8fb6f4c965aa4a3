"""Every registered query with SQL against DuckDB; the others must give rows."""

import math

import duckdb
import pandas as pd
import pytest

from quillcast.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return str(v) if isinstance(v, (str, bool)) or not isinstance(v, (int, float)) else round(float(v), 6) + 0.0

    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=str)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_against_sql(spark, sf, con, name):
    got, want = catalog.QUERIES[name](spark, sf).toPandas(), con.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert [len(got)] + rows(got)[:0] == [len(want)]
    assert str(rows(got)).replace("'True'", "True") == str(rows(want)).replace("'True'", "True")


@pytest.mark.parametrize("name", [k for k in catalog.QUERIES if k not in catalog.ORACLES and not k.startswith("q40")])
def test_gives_rows(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0
