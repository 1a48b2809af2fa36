"""Every registered query of the reference's operators against its SQL, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from quern.plans.registry import ORACLES, QUERIES
from quern.session import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if hasattr(x, "item"):
        x = x.item()
        if isinstance(x, float) and math.isnan(x):
            return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return float(f"{x:.9g}")
    return str(x).removesuffix(" 00:00:00")


def rows(frame):
    names = sorted(frame.columns)
    found = [tuple(plain(x) for x in r) for r in frame[names].astype(object).itertuples(index=False)]
    return names, sorted(found, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    got = rows(QUERIES[name](spark, SF).toPandas())
    assert got == rows(db.execute(ORACLES[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
