import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from firnline.llm import boosting, langid, quality, toxicity
from firnline.llm.textkern import NOT_SPACE, Words, chunks, shingles

EN = "the of and to in is that for it was on with as his they at be this from have or by one had not but what all were when".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split()


def prose(rng, vocabulary, n=60):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def test_words_and_shingles_match_python():
    texts = ["a bb  ccc\tdd e f g", "", None, "  x ", "é ü ö", "one two three four five"]
    rows = 0
    for a, b, data, offsets in chunks(pa.array(texts)):
        w = Words(data, offsets, NOT_SPACE)
        part = [(t or "").encode().split() for t in texts[a:b]]
        assert w.count.tolist() == [len(p) for p in part]
        assert [bytes(data[s:e]) for s, e in zip(w.start, w.end)] == [x for p in part for x in p]
        _, row = shingles(w.hashes(data), w.first, 5)
        assert np.bincount(row, minlength=b - a).tolist() == [max(1, len(p) - 4) if p else 0 for p in part]
        rows += b - a
    assert rows == len(texts)


def test_equal_words_have_equal_hashes_at_any_place():
    (chunk,) = chunks(pa.array(["x abc y", "abc", "zz abc"]))
    w = Words(chunk[2], chunk[3], NOT_SPACE)
    h = w.hashes(chunk[2])
    names = [bytes(chunk[2][s:e]) for s, e in zip(w.start, w.end)]
    assert len({int(x) for x, n in zip(h, names) if n == b"abc"}) == 1 and len({int(x) for x in h}) == 4


def test_gram_counts_match_a_loop():
    text = "Ab, éa b!"
    row, gram, count = langid.gram_counts([text, "ab"])
    padded = "".join(c if c.isalpha() else " " for c in " " + text.lower() + " ")
    want = {}
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if (n == 1 and g != " ") or (n == 2 and g != "  ") or (n == 3 and g[1] != " "):
                want[g] = want.get(g, 0) + 1
    assert sorted(count[row == 0].tolist()) == sorted(want.values()) and (row == 0).sum() == len(want)


def test_ranks_and_distance_match_a_loop():
    rng = random.Random(2)
    texts = [prose(rng, EN), prose(rng, DE, 5), "a"]
    counts = langid.gram_counts(texts)
    row, gram, rank = langid.ranked(*counts, 3, 40)
    for r in range(3):
        mine = sorted(((-c, g) for k, g, c in zip(*counts) if k == r))[:40]
        assert [g for _, g in mine] == gram[row == r].tolist() and rank[row == r].tolist() == list(range(len(mine)))
    profile = {"x": gram[row == 0].tolist()[::-1], "y": gram[row == 1].tolist()}
    names, score = langid.Profiles(profile, 40).predict(texts[:1])
    away = {k: sum(abs(i - p.index(g)) if g in p else 40 for i, g in enumerate(gram[row == 0].tolist())) for k, p in profile.items()}
    best = min(sorted(away), key=away.get)
    assert names == [best] and abs(score[0] - (1 - away[best] / (40 * (row == 0).sum()))) < 1e-12


def test_language_of_held_out_texts(spark, docs):
    rng = random.Random(4)
    rows = [(i, prose(rng, EN if i % 2 else DE), "en" if i % 2 else "de", "s", 0) for i in range(80)]
    rows += [(200, None, "en", "s", 0), (201, "", None, "s", 0), (202, "12 !?", "en", "s", 0), (203, "the " * 30000, None, None, 0)]
    frame = docs(rows)
    profiles = langid.fit_profiles(frame.filter("doc_id < 40"))
    out = {r["doc_id"]: r for r in langid.identify(frame, profiles).collect()}
    assert all(out[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(80))
    assert [out[i]["lang_pred"] for i in (200, 201, 202, 203)] == ["und", "und", "und", "en"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert langid.fit_profiles(frame.limit(0)) == {}
    assert {r["lang_pred"] for r in langid.identify(frame, {}).collect()} == {"und"}
    assert langid.identify(frame.limit(0), profiles).count() == 0


def test_trees_learn_and_match_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x, y, np.ones(600), trees=40)
    assert ((model.predict(x) > 0.5) == y).mean() > 0.95
    b = model.bins(x)
    for i in (0, 17, 300):
        total = model.start
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(b[i, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        assert abs(total - model.margin(x[i : i + 1])[0]) < 1e-9
    flat = boosting.fit(x, np.ones(600), np.ones(600))
    assert len(flat.feature) == 0 and np.allclose(flat.predict(x), flat.predict(x[:1]))


def labelled(spark, docs, bad):
    rng = random.Random(9)
    rows = [(i, prose(rng, EN) + (bad(rng) if i % 3 == 0 else "")) for i in range(150)]
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1, 1 if i % 3 == 0 else 0) for i in range(120)], "doc_id long, quality int, toxic int")
    return docs([*rows, (500, None), (501, ""), (502, "### " * 40000)]), labels


def test_quality_of_held_out_documents(spark, docs):
    frame, labels = labelled(spark, docs, lambda rng: " $$$ ###" * rng.randrange(10, 30))
    model = quality.fit_quality(frame, labels, F.col("doc_id") < 120)
    out = {r["doc_id"]: r["score"] for r in quality.score_quality(frame, model).collect()}
    assert all((out[i] >= 0.5) == (i % 3 != 0) for i in range(120, 150))
    assert len(out) == 153 and all(0 <= s <= 1 for s in out.values()) and out[502] < 0.5
    none = quality.fit_quality(frame, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score_quality(frame, none).collect()} == {0.5}


def test_statistics_do_not_depend_on_neighbours():
    texts = ["One two. Two!\nthree", "", "é é é", "x" * 5000]
    whole = np.concatenate([quality.statistics(d, o) for _, _, d, o in chunks(pa.array(texts))])
    alone = np.concatenate([quality.statistics(d, o) for t in texts for _, _, d, o in chunks(pa.array([t]))])
    assert np.allclose(whole, alone)


def maximal_by_force(scores):
    """Ruzzo and Tompa by recursion: the best segment (shortest, then first), then both sides."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[0] + 1e-12 or (abs(total - best[0]) <= 1e-12 and j - i < best[2] - best[1] - 1)):
                best = (total, i, j + 1)
    if best is None:
        return []
    _, a, b = best
    left = maximal_by_force(scores[:a])
    right = [(i + b, j + b, s) for i, j, s in maximal_by_force(scores[b:])]
    return left + [(a, b, best[0])] + right


def test_maximal_segments_match_brute_force():
    rng = random.Random(11)
    for _ in range(200):
        scores = np.array([rng.choice([-1.25, -0.5, 0.75, 1.5, 2.125]) for _ in range(rng.randrange(0, 25))])
        got = sorted((a, b, round(s, 9)) for a, b, s in toxicity.maximal_segments(scores))
        assert got == sorted((a, b, round(s, 9)) for a, b, s in maximal_by_force(scores.tolist()))


def test_toxicity_of_held_out_documents(spark, docs):
    insults = ["gromble", "snarfed", "blorky"]
    frame, labels = labelled(spark, docs, lambda rng: " " + " ".join(rng.choice(insults) for _ in range(4)))
    model = toxicity.fit_toxicity(frame, labels, F.col("doc_id") < 120)
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(frame, model).collect()}
    assert all((out[i]["score"] >= 0.5) == (i % 3 == 0) for i in range(120, 150))
    text = {r["doc_id"]: r["text"] for r in frame.collect()}
    first = out[120]["passages"].split(",")[0].split(":")
    assert any(x in text[120][int(first[0]) : int(first[1])] for x in insults)
    assert out[500]["score"] < 0.5 and out[501]["n_passages"] == 0 and len(out) == 153
    none = toxicity.fit_toxicity(frame, labels.limit(0), F.lit(True))
    assert all(r["score"] < 0.5 for r in toxicity.score_toxicity(frame, none).collect())


@pytest.mark.parametrize("x, y", [(4, "abcdefgh"), (6, "éüöäßñabc")])
def test_prefix_units_are_code_points(x, y):
    (c,) = chunks(pa.array([y, y[:x] + "zzzz", y[:x]]))
    w = Words(c[2], c[3], toxicity.LETTERS)
    h = toxicity.unit_hashes(c[2], w)[toxicity.PREFIXES.index(x)]
    assert h[0] == h[1] != h[2]


def test_any_number_of_languages(spark):
    rows = [(i, f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]} " * 5, f"l{i % 600:03d}") for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.fit_profiles(frame)
    assert len(profiles) == 600
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame, profiles).collect()}
    assert all(out[i] == lang for i, _, lang in rows)


def test_profiles_equal_a_plain_loop():
    profiles = {"b": [5, 9, 7], "a": [9, 5], "c": []}
    texts = ["abc abd", "zz", "", "a b c d"]
    model = langid.Profiles(profiles, 4)
    row, gram, rank = langid.ranked(*langid.gram_counts(texts), len(texts), 4)
    for i in range(len(texts)):
        mine = [(g, r) for x, g, r in zip(row.tolist(), gram.tolist(), rank.tolist()) if x == i]
        away = {n: sum(abs(p.index(g) - r) if g in p else 4 for g, r in mine) for n, p in profiles.items()}
        want = min(sorted(away), key=away.get) if mine else "und"
        names, score = model.predict(texts)
        assert names[i] == want and abs(score[i] - (1 - away[want] / (4 * len(mine)) if mine else 0)) < 1e-12
