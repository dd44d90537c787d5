import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from firnline.llm import minhash as M
from firnline.llm.textkern import chunks


def weighted(text):
    w = text.lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard(a, b):
    a, b = weighted(a), weighted(b)
    return sum((a & b).values()) / sum((a | b).values())


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def classes_by_force(rows):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    full = [(i, t) for i, t in rows if t and t.split()]
    for k, (i, t) in enumerate(full):
        for j, s in full[:k]:
            if t == s or jaccard(t, s) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}


def found(docs_frame):
    rows, classes, _ = M.near_duplicates(docs_frame)
    out = rows.join(classes.select("node", "class_id"), "node", "left").collect()
    return {r["doc_id"]: r["class_id"] if r["class_id"] is not None else r["doc_id"] for r in out}


def test_signature_estimates_weighted_jaccard():
    rng = random.Random(1)
    base = words(rng, 300)
    for edits in (2, 10, 40):
        other = list(base)
        for k in rng.sample(range(300), edits):
            other[k] = "x" + other[k]
        texts = [" ".join(base), " ".join(other + base[:60])]
        ((_, _, data, offsets),) = chunks(pa.array(texts))
        s = M.signatures(*M.weighted_sets(data, offsets), 2, 4000)
        assert abs((s[0] == s[1]).mean() - jaccard(*texts)) < 0.03
        assert abs(M.similarities(pa.array(texts[:1]), pa.array(texts[1:]))[0] - jaccard(*texts)) < 1e-9


def test_fractional_weights_agree_in_proportion():
    row, element = np.array([0, 0, 1, 1]), np.array([1, 2, 1, 2], np.uint64)
    s = M.signatures(row, element, np.array([1.0, 2.5, 0.5, 2.5]), 2, 6000)
    assert abs((s[0] == s[1]).mean() - 3.0 / 3.5) < 0.02


def test_classes_match_brute_force(docs):
    rng = random.Random(7)
    rows, k = [], 0
    for _ in range(12):
        base = words(rng, rng.choice([6, 30, 120]))
        for _ in range(rng.randrange(1, 8)):
            copy = list(base)
            for j in rng.sample(range(len(copy)), rng.randrange(0, max(1, len(copy) // 12))):
                copy[j] = f"e{rng.randrange(10**6)}"
            rows.append((k, " ".join(copy)))
            k += 1
    rows += [(k, rows[0][1]), (k + 1, None), (k + 2, ""), (k + 3, " \n"), (k + 4, "two words"), (k + 5, "Two  words")]
    assert found(docs(rows)) == classes_by_force(rows) | {k + 5: k + 4}


def test_chain_of_a_hot_group(docs):
    """Many copies of one text, each changed in up to three places, and heavily changed ones that link to nothing."""
    rng = random.Random(3)
    base = words(rng, 150)
    rows = []
    for i in range(120):
        copy = list(base)
        for j in rng.sample(range(150), rng.choice([0, 1, 2, 3, 8, 12])):
            copy[j] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    assert found(docs(rows)) == classes_by_force(rows)


def test_repeated_rows_long_texts_and_empty_tables(docs):
    long = " ".join(f"a{i}" for i in range(60000))
    rows = [(5, long), (5, long), (3, long + " b"), (9, "x")]
    assert found(docs(rows)) == {5: 3, 3: 3, 9: 9}
    assert found(docs([(1, "x")]).limit(0)) == {}


def test_stage_keeps_one_of_each_class(spark, docs):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "a b c d e f g h"), (3, None), (4, "other words are here now"), (4, "other words are here now")]
    out = M.stage(spark, docs(rows), "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in out if r["text"]) == [(1, rows[0][1]), (4, rows[4][1])]
    assert [r["doc_id"] for r in out if r["text"] is None] == [3]


def test_components_of_long_chains(spark):
    edges = [(bytes([0, i]), bytes([0, i + 1])) for i in range(1, 60)] + [(b"\x01\x01", b"\x01\x02")]
    out = {bytes(r["node"]): bytes(r["component"]) for r in M.components(spark.createDataFrame(edges, "u binary, v binary")).collect()}
    assert set(out.values()) == {bytes([0, 1]), b"\x01\x01"} and len(out) == 62


@pytest.mark.parametrize("extra", ["node", "bands", "bucket", "component", "u"])
def test_clashing_columns(docs, extra):
    from pyspark.sql import functions as F

    frame = docs([(1, "a b c d e f"), (2, "a b c d e f")]).withColumn(extra, F.lit(1))
    assert found(frame) == {1: 1, 2: 1}


def test_stage_with_helper_names(spark, docs):
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, base), (2, base), (3, base + " more"), (4, "quite another text of some words"), (4, "quite another text of some words"), (None, "no id here at all"), (5, ""), (5, "")]
    names = ["__n", "__id", "__node", "__rn", "node", "doc", "n", "may", "stays", "own_node", "marked_id", "sieve_word", "a.b", "marked_MAY"]
    odd = docs(rows).withColumns({c: F.lit(c) for c in names})
    out = M.stage(spark, odd, "")
    got = out.collect()
    assert out.columns == odd.columns and all(r[c] == c for r in got for c in names)
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, 1, 4, 5, 5]


def test_hot_buckets_are_salted(spark, docs, monkeypatch):
    monkeypatch.setattr(M, "HOT", 10**6)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(150):
        t = list(base)
        t[rng.randrange(60)] = f"x{i % 40}"
        rows.append((i, " ".join(t)))
    out = {r["doc_id"]: r["class_id"] for r in classes_of(docs(rows))}
    monkeypatch.setattr(M, "HOT", 1)
    assert out == {r["doc_id"]: r["class_id"] for r in classes_of(docs(rows))} and len(set(out.values())) < 20


def classes_of(df):
    rows, classes, _ = M.near_duplicates(df)
    return rows.join(classes, "node", "left").collect()
