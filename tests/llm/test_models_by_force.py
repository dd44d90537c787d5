"""The quality and toxicity queries and the pipeline against plain versions of their whole definitions."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from firnline.llm import boosting, mixing, quality, secrets, spm, toxicity
from firnline.llm.textkern import chunks
from test_minhash import jaccard

EN = "the of and to in is that for it with as was on be at by this had not are but from or have an they which one you were all her she there would their we him been has when who will no more if out so".split()
BAD = ["gromble", "snarfed", "blorky", "gromblish", "snarfing"]


def entropy_of(shares):
    return -sum(p * math.log2(p) for p in shares if p > 0)


def plain_statistics(text):
    """The thirty statistics of one text, character class by character class."""
    data = text.encode()
    of = {}
    for name, members in (
        ("space", b" \t"), ("newline", b"\n\r"), ("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)), ("symbol", b"#$%&*+/<=>@\\^_`|~"),
        ("period", b"."), ("comma", b",;:-"), ("bang", b"!?"), ("bracket", b"()[]{}"), ("quote", b"\"'"), ("lead", range(192, 256)), ("tail", range(128, 192)),
    ):
        of |= {b: name for b in members}
    kind = [of.get(b, "control") for b in data]
    names = ["space", "newline", "upper", "lower", "digit", "period", "comma", "bang", "bracket", "quote", "symbol", "lead", "tail", "control"]
    share = [kind.count(n) / max(len(data), 1) for n in names]
    words = [w for w in re.split(rb"[ \t\n\v\f\r]+", data) if w]
    lengths, n = [len(w) for w in words], max(len(words), 1)
    mean = sum(lengths) / n
    sdev = math.sqrt(max(sum(x * x for x in lengths) / n - mean**2, 0))
    at = lambda w, i: of.get(w[min(i, len(w) - 1)] if i >= 0 else w[-1], "control")
    part = lambda test: sum(bool(test(w)) for w in words) / n
    counts = Counter(words)
    fives = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
    lines = [x for x in data.split(b"\n") if x]
    letters = kind.count("upper") + kind.count("lower")
    return [
        math.log1p(len(data)), math.log1p(len(words)), mean, sdev, max(lengths, default=0), *share, kind.count("upper") / max(letters, 1), part(lambda w: at(w, -1) in ("period", "comma", "bang")),
        part(lambda w: at(w, -1) == "symbol" or at(w, 0) == "symbol"), part(lambda w: at(w, 0) == "upper" and at(w, 1) == "upper"), len(counts) / n, max(counts.values(), default=0) / n,
        len(set(fives)) / max(len(fives), 1), math.log1p(len(lines)), len(set(lines)) / max(len(lines), 1), len(data) / max(len(lines), 1), entropy_of(share),
    ]


def prose(rng, n):
    return " ".join(rng.choice(EN) + rng.choice(["", "", "", ",", "."]) for _ in range(n)).capitalize()


def odd_texts(rng, n):
    pieces = ["The", "QUICK", "a", "x1", "$$", "#tag", "é", "日本", "😀", "(b)", '"q"', "\n", "\n\n", "\t", "  ", ".", "!", "the the the", "\x01", "--"]
    return ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def test_statistics_by_force():
    rng = random.Random(2)
    texts = ["", " ", "word", "A", *odd_texts(rng, 150), *[prose(rng, 40) for _ in range(20)]]
    got = np.concatenate([quality.statistics(d, o) for _, _, d, o in chunks(pa.array(texts))])
    assert got.shape == (len(texts), 30) == (len(texts), len(quality.FEATURES))
    for t, row in zip(texts, got):
        assert np.allclose(row, plain_statistics(t), atol=1e-9), t


def slow_fit(x, y, weight, trees, depth, rate, bins, l2, least):
    """Boosting by loops: [(feature, cut, leaf) of each tree], and the margins of the rows."""
    n, k = x.shape
    base = min(max(float((weight * y).sum() / weight.sum()), 1e-3), 1 - 1e-3)
    start = math.log(base / (1 - base))
    edges = [np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]) for f in range(k)]
    b = [[sum(e < x[i, f] for e in edges[f]) for f in range(k)] for i in range(n)]
    margin, out = [start] * n, []
    for _ in range(trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [weight[i] * (p[i] - y[i]) for i in range(n)]
        h = [weight[i] * p[i] * (1 - p[i]) for i in range(n)]
        node, feature, cut = [0] * n, [0] * (2**depth - 1), [bins] * (2**depth - 1)
        for level in range(depth):
            for j in range(2**level):
                rows, best = [i for i in range(n) if node[i] == j], 0.0
                gt, ht, ct = (sum(v[i] for i in rows) for v in (g, h, weight))
                for f in range(k):
                    top, choice = 0.0, None
                    for c in range(bins):
                        left = [i for i in rows if b[i][f] <= c]
                        gl, hl, cl = (sum(v[i] for i in left) for v in (g, h, weight))
                        if cl < least or ct - cl < least:
                            continue
                        gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                        if gain > top + 1e-12:
                            top, choice = gain, c
                    if choice is not None and top > best + 1e-9:
                        best, feature[2**level - 1 + j], cut[2**level - 1 + j] = top, f, choice
            node = [2 * node[i] + (b[i][feature[2**level - 1 + node[i]]] > cut[2**level - 1 + node[i]]) for i in range(n)]
        leaf = [-rate * sum(g[i] for i in range(n) if node[i] == j) / (sum(h[i] for i in range(n) if node[i] == j) + l2) for j in range(2**depth)]
        margin = [m + leaf[node[i]] for i, m in enumerate(margin)]
        out.append((feature, cut, leaf))
    return out, margin


def test_boosting_by_force():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.normal(size=60)) > 0.3).astype(float)
    weight = rng.uniform(0.5, 2.0, 60)
    model = boosting.fit(x, y, weight, trees=6, depth=3, bins=8, least=3.0)
    slow, margin = slow_fit(x, y, weight, 6, 3, 0.15, 8, 2.0, 3.0)
    for i, (feature, cut, leaf) in enumerate(slow):
        assert model.feature[i].tolist() == feature and model.cut[i].tolist() == cut and np.allclose(model.leaf[i], leaf)
    assert np.allclose(model.margin(x), margin)


def crc_mod(i, m):
    import zlib

    return zlib.crc32(str(i).encode()) % m


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with documents and labels: toxic every fifth, of low quality every third."""
    rng = random.Random(8)
    rows = []
    for i in range(160):
        text = prose(rng, rng.randrange(15, 60))
        if i % 5 == 0:
            words = text.split()
            at = rng.randrange(len(words))
            text = " ".join(words[:at] + [rng.choice(BAD) for _ in range(5)] + words[at:])
        if i % 3 == 0:
            text += " $$$ ###" * rng.randrange(5, 20)
        if i % 11 == 0:
            text += " password = 'Hunter2xyz99'"
        rows.append((i, text, "en", "abc"[i % 3], len(text)))
    rows += [(200 + i, rows[i][1] + " and more", "en", "b", 0) for i in range(1, 30, 4)] + [(300, None, None, None, None), (301, "", "en", "a", 0), (1, rows[1][1], "en", "a", 1)]
    path = tmp_path_factory.mktemp("small")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if i % 3 == 0 else 1, 1 if i % 5 == 0 else 0) for i in range(140)] + [(150, None, None), (999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, labels


def test_quality_query_by_force(spark, small):
    path, rows, labels = small
    known = {i: q for i, q, _ in labels if q is not None and crc_mod(i, 5) != 0}
    text = {}
    for i, t, *_ in rows:
        text.setdefault(i, t)
    learn = [(plain_statistics(text[i]), q) for i, q in known.items() if i in text]
    x, y = np.array([s for s, _ in learn]), np.array([q for _, q in learn], float)
    order = np.lexsort((*x.T, y))
    sizes = Counter(known.values())
    got = Counter(y.tolist())
    weight = np.array([sizes[int(c)] / got[c] for c in y[order]])
    model = boosting.fit(x[order], y[order], weight * (len(y) / weight.sum()))
    out = quality.op4_quality(spark, path).collect()
    assert len(out) == len(rows)
    for r in out:
        b = [int(np.searchsorted(model.edges[f], v, "left")) for f, v in enumerate(plain_statistics(text[r["doc_id"]] or ""))]
        margin = model.start
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (b[feature[node]] > cut[node])
            margin += leaf[node - len(feature)]
        assert abs(r["score"] - 1 / (1 + math.exp(-margin))) < 1e-9 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (crc_mod(r["doc_id"], 5) == 0)


def units_of(word):
    return [("p", k, word[:k]) if len(word) > k else ("w", word) for k in toxicity.PREFIXES] + [("w", word)]


def words_of(text):
    return re.findall(r"[a-zA-Z\u0080-\U0010ffff]+", (text or "").lower())


def plain_evidence(scores, rate):
    """Over the maximal segments of a text's word scores."""
    found = sorted((s for _, _, s in toxicity.maximal_segments(np.array(scores))), reverse=True) if scores else []
    best = total = 0.0
    for r, s in enumerate(found, 1):
        total += rate * s - math.log(max(len(scores), 1))
        if total <= 0:
            break
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
    return best


def test_toxicity_query_by_force(spark, small):
    path, rows, labels = small
    known = {i: t for i, _, t in labels if t is not None and crc_mod(i, 5) != 0}
    first = {}
    for i, t, *_ in rows:
        if t is not None and i in known:
            first[i] = min(first.get(i, t), t)
    sample = {}
    for i, t in sorted(first.items()):
        sample.setdefault((known[i], t), i)
    ids = spark.createDataFrame([(i,) for i in sample.values()], "doc_id long")
    held = {r["doc_id"] for r in ids.filter(F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0).collect()}
    t_count, c_count = Counter(), Counter()
    for (label, text), i in sample.items():
        if i not in held:
            (t_count if label else c_count).update({u for w in words_of(text) for u in units_of(w)})
    nt, nc = sum(t_count.values()), sum(c_count.values())
    prior, odds = toxicity.PRIOR * (nt + nc), {}
    for u in set(t_count) | set(c_count):
        t, c = t_count[u], c_count[u]
        a = prior * (t + c) / (nt + nc)
        delta = math.log((t + a) / (nt + prior - t - a)) - math.log((c + a) / (nc + prior - c - a))
        if abs(delta / math.sqrt(1 / (t + a) + 1 / (c + a))) >= toxicity.Z_MIN:
            odds[u] = delta

    def scores_of(text):
        return [next((odds[u] for u in reversed(units_of(w)) if u in odds), 0.0) - toxicity.DRIFT for w in words_of(text)]

    background = Counter(float(np.round(s, 2)) for (label, text), i in sample.items() if i in held and not label for s in scores_of(text))
    top = max(background)
    rate = 1.0
    if top > 0:
        weights = {s: n + (0.5 if s == top else 0) for s, n in background.items()}
        total, low, high = sum(weights.values()), 1e-3, 60.0
        for _ in range(60):
            middle = (low + high) / 2
            if sum(w / total * math.exp(middle * s) for s, w in weights.items()) < 1:
                low = middle
            else:
                high = middle
        rate = low
    points = [(plain_evidence(scores_of(text), rate), label) for (label, text), i in sample.items() if i in held]
    sizes, got = Counter(known.values()), Counter(label for _, label in points)
    values = sorted({e for e, _ in points})
    wrong = [sum(sizes[y] / got[y] for e, y in points if (e <= a) == (y == 1)) for a in values[:-1]]
    least = min(wrong)
    gap = max(((values[i + 1] - values[i], -i) for i, w in enumerate(wrong) if w <= least + 1e-9 * sum(sizes.values())), default=(0, 0))
    cut = (values[-gap[1]] + values[-gap[1] + 1]) / 2
    model = toxicity.fit_toxicity(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"), toxicity.split_mod("doc_id", 5) != 0)
    assert len(model.keys) == len(odds) and abs(model.rate - rate) < 1e-6 and abs(model.cut - cut) < 1e-6
    text = {}
    for i, t, *_ in rows:
        text.setdefault(i, t)
    out = toxicity.op7_toxicity(spark, path).collect()
    assert len(out) == len(rows)
    for r in out:
        e = plain_evidence(scores_of(text[r["doc_id"]]), rate)
        assert abs(r["score"] - 1 / (1 + math.exp(-min(max(e - cut, -30), 30)))) < 1e-6 and r["predicted"] == (r["score"] >= 0.5)
    assert sum(r["predicted"] for r in out) > 20


def test_pipeline_by_force(spark, small):
    path, rows, _ = small
    score = {}
    for r in toxicity.op7_toxicity(spark, path).collect():
        score[r["doc_id"]] = r["score"]
    docs = [r for r in rows if score[r[0]] < 0.5]
    # one document of each class, by all pairs
    with_words = [r for r in docs if (r[1] or "").split()]
    kept, parent = [r for r in docs if not (r[1] or "").split()], list(range(len(with_words)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(with_words):
        for j in range(i):
            if a[1] == with_words[j][1] or jaccard(a[1], with_words[j][1]) >= 0.8:
                parent[find(i)] = find(j)
    classes = {}
    for i, r in enumerate(with_words):
        classes.setdefault(find(i), []).append(r)
    kept += [min(c, key=lambda r: r[0]) for c in classes.values()]
    clean = {}
    for i, t, lang, source, n in kept:
        new = t if t is None else secrets.redact(t, secrets.find_spans(t))
        clean[i] = (i, new, lang, source, n if new == t else len(new))
    frame = spark.createDataFrame(list(clean.values()), "doc_id long, text string, lang string, source string, n_chars long")
    taken = {r["doc_id"]: r["copies"] if r["size"] else max(r["copies"], 1) for r in mixing.mix_sources(frame).collect()}
    out = corpus_pipeline.run(spark, path).collect()
    assert Counter(r["doc_id"] for r in out) == Counter({i: n for i, n in taken.items() if n})
    assert len(kept) < len(docs) < len(rows) and any("<SECRET>" in (t or "") for _, t, *_ in clean.values())
    if os.path.exists(spm.MODEL_PATH):
        sentencepiece = pytest.importorskip("sentencepiece")
        lib = sentencepiece.SentencePieceProcessor(model_file=spm.MODEL_PATH)
        assert all(r["tokens"] == lib.encode(clean[r["doc_id"]][1] or "") for r in out)
