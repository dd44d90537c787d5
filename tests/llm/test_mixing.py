import random

import numpy as np
import pytest

from firnline.llm import mixing


def targets_by_force(sizes):
    """sizes: source -> words. Shares by weight; what exceeds three times the size is shared again until none does."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, open_, rest = {}, list(names), float(sum(sizes.values()))
    while True:
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        full = [s for s in open_ if weight[s] * level > 3 * sizes[s] + 1e-9]
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        open_ = [s for s in open_ if s not in full]


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "é", "Z", None])
        size = 0 if rng.random() < 0.05 else int(rng.lognormvariate(3, 1)) + 1
        rows.append((i, " \t".join(["w"] * size), "en", source, 0))
    return rows + [(10**6, None, "en", "a", 0), (10**6 + 1, "w " * 30, "en", "tiny", 0), (10**6 + 1, "w " * 30, "en", "tiny", 0)]


@pytest.mark.parametrize("n, group", [(300, 2048), (4000, 64)])
def test_mix(spark, docs, n, group, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", group)
    rows = corpus(n)
    out = mixing.mix_sources(docs(rows)).collect()
    assert len(out) == len(rows)
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    want = targets_by_force(size)
    for s in size:
        mine = [r for r in out if r["source"] == s]
        assert abs(mine[0]["target"] - want[s]) < 1e-6 and mine[0]["source_size"] == size[s]
        largest = max(r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= largest
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in out)
    again = mixing.mix_sources(docs(rows[::-1]).repartition(3)).collect()
    assert sorted((r["doc_id"], r["h"], r["taken"]) for r in out) == sorted((r["doc_id"], r["h"], r["taken"]) for r in again)


def test_pivot_run_keeps_mass_and_is_fair():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 50, 12).astype(float)
    total = np.zeros(12)
    for _ in range(6000):
        out, held, hp, _, _ = mixing.pivot_run(size, np.full(12, 0.3), rng.random(12))
        if held is not None:
            out[held] = hp
        assert abs((out * size).sum() - 0.3 * size.sum()) < 1e-6
        assert ((out > 1e-12) & (out < 1 - 1e-12)).sum() <= 1
        total += out
    assert np.abs(total / 6000 - 0.3).max() < 0.03


def test_root_is_fair_and_near():
    rng = np.random.default_rng(1)
    size = np.sort(rng.integers(1, 200, 20))[::-1].astype(float)
    p, total, off = np.linspace(0.2, 0.8, 20), np.zeros(20), []
    for _ in range(4000):
        out = mixing.round_root(size, p, rng.random(20))
        assert set(np.unique(out)) <= {0.0, 1.0}
        total += out
        off.append(abs((out * size).sum() - (p * size).sum()))
    assert np.abs(total / 4000 - p).max() < 0.05 and np.mean(off) < 20


def test_empty_and_wordless(spark, docs):
    assert mixing.mix_sources(docs([(1, "a")]).limit(0)).count() == 0
    out = mixing.mix_sources(docs([(1, None), (2, ""), (3, " ")])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in out] == [(0, 0, 0.0)] * 3


def test_stage_repeats_documents(spark, docs):
    rows = corpus(200, 5)
    out = mixing.stage(spark, docs(rows), "").collect()
    took = {}
    for r in mixing.mix_sources(docs(rows)).collect():
        took[r["doc_id"]] = took.get(r["doc_id"], 0) + (r["copies"] if r["size"] else max(1, r["copies"]))
    got = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in took.items() if v}
    assert out[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_many_repeated_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 16)
    monkeypatch.setattr(mixing, "SPLIT", 100)
    rows = corpus(400, 7) + [(5, "one two three", "en", "a", 13)] * 3000
    out = mixing.mix_sources(docs(rows)).collect()
    assert len(out) == len(rows)
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    want = targets_by_force(size)
    for s in size:
        mine = [r for r in out if r["source"] == s]
        assert abs(mine[0]["target"] - want[s]) < 1e-6 and abs(sum(r["taken"] for r in mine) - want[s]) <= max(r["size"] for r in mine)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    stage = mixing.stage(spark, docs(rows), "").filter("doc_id = 5").count()
    assert stage == sum(r["copies"] for r in out if r["doc_id"] == 5)


@pytest.mark.parametrize("n", [1, 7, 500])
def test_targets_of_many_sources(spark, n):
    rng = random.Random(n)
    sizes = {f"s{rng.randrange(10**6)}": rng.randrange(0, 900) for _ in range(n)} | {None: 4}
    units = spark.createDataFrame([(s, v, 1) for s, v in sizes.items()], "source string, size long, times long").repartition(3)
    got = {r["source"]: r["target"] for r in mixing.source_targets(units).collect()}
    want = targets_by_force(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_stage_with_helper_names(spark, docs):
    from pyspark.sql import functions as F

    rows = corpus(60, 3) + [(3, "same words", "en", "a", 10)] * 2
    plain = mixing.stage(spark, docs(rows), "").count()
    names = ["__n", "__id", "__th", "__h", "__rn", "__c", "took_id", "took_h", "took_n", "nth", "times", "a.b", "N"]
    odd = docs(rows).withColumns({c: F.lit(c) for c in names})
    out = mixing.stage(spark, odd, "")
    assert out.columns == odd.columns and out.count() == plain and all(r[c] == c for r in out.limit(5).collect() for c in names)
