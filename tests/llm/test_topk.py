import random

import numpy as np
from pyspark.sql import functions as F

from firnline.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, label int"


def force(rows, k=10):
    good = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for i, q in good:
        if i % 100 == 0:
            scored = sorted((-int(q @ x), j) for j, x in good if j != i and len(x) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in T.top_k(df, F.col("vec_id") % 100 == 0).collect())


def test_matches_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(24)], 0) for i in range(450)]
    rows += [(600 + i, rows[7][1], 0) for i in range(40)]  # one very common vector
    assert found(spark.createDataFrame(rows, SCHEMA)) == force(rows)


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, float("nan")], 0), (2, None, 0), (3, [], 0), (4, [1.0, None], 0), (5, [float("inf"), 0.0], 0), (6, [0.5, 0.5], 0), (7, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0), (100, [3.0], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [(0, 1, 6, 512 * 1024 + 512 * 2048)]
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_huge_components_stay_exact(spark):
    rows = [(0, [1e9, -1e9, 1.0], 0), (1, [1e9, 1e9, 0.25], 0), (2, [1e9, 1e9, 0.5], 0)]
    q = [int(np.floor(1024 * float(np.float32(x)))) for x in rows[0][1]]
    want = sorted(((-max(-(2**63), min(2**63 - 1, sum(a * int(np.floor(1024 * float(np.float32(b)))) for a, b in zip(q, v)))), i) for i, v, _ in rows[1:]))
    assert [(r[2], r[3]) for r in found(spark.createDataFrame(rows, SCHEMA))] == [(i, -s) for s, i in want]


def test_bounds_hold():
    rng = np.random.default_rng(0)
    q, x = rng.normal(size=(30, 64)), rng.normal(size=(50, 64))
    exact = ((q[:, None] - x[None]) ** 2).sum(-1)
    for parts in T.LEVELS:
        low = T.lower_bound(T.segment_statistics(q, parts), T.segment_statistics(x, parts))
        assert (low <= exact + 1e-9).all()


def test_pruning_leaves_few():
    rng = np.random.default_rng(1)
    x = np.floor(300 * np.cumsum(rng.normal(size=(3000, 64)), axis=1))
    s = T.Search(np.arange(20), x[:20], np.full(20, -np.inf), 10)
    for a in range(0, 3000, 500):
        s.add(np.arange(a, a + 500), x[a : a + 500])
    assert s.tested < 0.3 * s.total


def test_grid_of_many_cells_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "QUERY_BLOCK", 3)
    monkeypatch.setattr(T, "SLAB", 50)
    rng = random.Random(9)
    rows = [(i % 300, [rng.gauss(0, 0.3) for _ in range(8)], 0) for i in range(900)]
    rows += [rows[100]] * 60 + [(500, rows[1][1][:5], 0), (501, rows[2][1][:5], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == force(rows)
