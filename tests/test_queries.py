"""Every registered query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from firnline.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Queries without SQL; tests/test_retrackers.py holds their results against plain loops, row by row.
FORCED = {"lead_fit", "trailing_edge_fit", "local_regression", "gaussian_process", "deviation_filter", "transition_zone"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else str(v)


def _rows(frame, columns):
    return sorted([tuple(map(_plain, row)) for row in frame[columns].astype(object).values.tolist()], key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    if name not in catalogue.SQL:
        assert name in FORCED and len(got), "a query without SQL needs a test against a plain version"
        return
    want = duck.execute(catalogue.SQL[name]).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert _rows(got, columns) == _rows(want, columns)


def test_every_sql_has_a_query():
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)
