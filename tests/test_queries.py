"""Every query with SQL gives what DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from changeloom.plans.catalog import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def cell(v):
    if v is None or (not isinstance(v, str) and pd.isna(v)):
        return "~"
    return v if isinstance(v, str) else str(bool(v)) if "bool" in type(v).__name__ else repr(round(float(v), 6))


def rows(df):
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name in ORACLE_SQL:
        want = db.execute(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


def test_changelog_holds_the_hard_cases(spark):
    from changeloom.plans.changelog import flat_changelog

    f = flat_changelog(spark, DATA)
    assert f.where("op = 'u' and a_key = b_key and a_status = b_status and a_price = b_price").count() > 0
    # deletes of rows that were never updated
    assert f.where("op = 'd' and (seq div 10) % 3 <> 0 and (seq div 10) % 11 <> 0 and (seq div 10) % 13 <> 0").count() > 0
