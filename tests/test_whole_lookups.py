"""Lookups do the whole job: no reach, no subset."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline.operators import lookups
from firnline.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_edge_proximity_has_no_reach(spark):
    """A pack far wider than the tiles, a key without an edge, cells without ice or value."""
    rng = np.random.default_rng(3)
    rows = [(1, y, x, 0.0 if (x < 3 and y > 20) or (y, x) == (5, 44) else 90.0) for y in range(-10, 40) for x in range(50) if rng.random() > 0.05]
    rows += [(1, 41, 0, None)] + [(2, y, x, 90.0) for y in range(6) for x in range(6)]
    cells = spark.createDataFrame(rows, "day int, yj int, xi int, sic double")
    got = {(r["day"], r["yj"], r["xi"]): r["distance"] for r in lookups.edge_proximity(cells, "sic", 15.0, 2.0, 4, ["day"]).collect()}
    ice = np.array([r[1:3] for r in rows if r[0] == 1 and r[3] == 90.0])
    sea = np.array([r[1:3] for r in rows if r[3] == 0.0])
    edge = sea[(np.abs(sea[:, None] - ice[None]).max(2) <= 1).any(1)]
    far = np.sqrt(((ice[:, None] - edge[None]) ** 2).sum(2).min(1)) * 2.0
    assert len(got) == len(rows) and far.max() > 2.0 * 16
    assert all(got[(1, y, x)] == pytest.approx(d) for (y, x), d in zip(ice.tolist(), far))
    assert all(got[(1, y, x)] == 0.0 for y, x in sea.tolist()) and got[(1, 41, 0)] == 0.0
    assert {got[(2, y, x)] for y in range(6) for x in range(6)} == {None}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
def test_catalogues_are_whole(spark):
    """Every order has a chart; sibling records come for all orders with lines."""
    for name, column in (("closest_date", "chart_day"), ("valid_interval", "chart_id")):
        out = catalogue.QUERIES[name](spark, DATA)
        assert out.count() == spark.read.parquet(f"{DATA}/orders.parquet").count() and out.filter(f"{column} is null").isEmpty()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
def test_blocks_hold_every_component(spark):
    vectors = {r["vec_id"]: list(r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").limit(50).collect()}
    out = catalogue.QUERIES["flattened_blocks"](spark, DATA).filter(F.col("vec_id").isin(*vectors)).orderBy("vec_id", "record_idx").collect()
    for vec_id, v in vectors.items():
        mine = [r for r in out if r["vec_id"] == vec_id]
        assert [r["a"] for r in mine] + [r["b"] for r in mine] == pytest.approx(v, abs=1e-6)
