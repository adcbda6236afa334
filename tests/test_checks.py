"""Every registered query against its SQL, at the smallest scale."""

import glob
import os
from numbers import Number

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def canonical(frame):
    def text(v):
        if pd.isna(v):
            return ""
        return repr(float(v)) if isinstance(v, Number) and not isinstance(v, bool) else str(v)

    return sorted(tuple(text(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_agrees_with_sql(spark, engine, name):
    got = entry_point.queries()[name](spark, SF).toPandas()
    want = engine.sql(entry_point.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
