"""Every query against its SQL on the smallest tables, and the shape of the main plans."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[name]):
            df[name] = df[name].astype("datetime64[us]")
        elif not pd.api.types.is_numeric_dtype(df[name]):
            df[name] = df[name].astype(object)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sql, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    if name not in contract.oracle_sql():
        assert len(got)
        return
    got = plain(got)
    want = plain(sql.sql(contract.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    for column in got.columns:
        a, b = got[column], want[column]
        same = (a.to_numpy() == b.to_numpy()) | (pd.isna(a).to_numpy() & pd.isna(b).to_numpy())
        assert np.all(same), column


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    asked = contract.queries()
    # A search shuffles nothing but each task's best rows.
    dense = plan(asked["hist_search_dense"](spark, FOLDER))
    assert "TakeOrderedAndProject" in dense and "Join" not in dense
    # The top rows of each query are cut before the shuffle.
    assert "WindowGroupLimit" in plan(asked["hist_search_multi"](spark, FOLDER))
    # Comparing images and sliding templates are map-side: one broadcast of the small batch.
    for name in ("tamper_regions", "feature_search"):
        text = plan(asked[name](spark, FOLDER))
        assert "SortMergeJoin" not in text and "ENSURE_REQUIREMENTS" not in text
        assert "NestedLoop" not in text and "Cartesian" not in text
        # The kernel runs once per pair or image.
        assert text.count("ArrowEvalPython") + text.count("MapInArrow") == 1
    assert "CartesianProduct" not in "".join(plan(asked[n](spark, FOLDER)) for n in ("library_union", "log_summary"))
