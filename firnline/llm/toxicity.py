"""Toxicity by maximum-scoring segment search over token log-odds.

Fit: on about SAMPLE_PER_CLASS labelled documents of each class (chosen by a hash of the id, equal texts once).
A token's units are the word, its first six and its first four letters. For each unit the log-odds of the
toxic against the clean part of the sample's lexicon documents are shrunk by a Dirichlet prior with the pooled
counts as its mean (PRIOR of their mass); units count once a document. Units whose z-score passes Z_MIN keep
their log-odds, at most LEXICON of them; a word scores as its longest kept unit, less DRIFT.

Search: a linear-time scan finds all maximal scoring segments (Ruzzo and Tompa) of every text. Under the clean
background a segment's score S has an extreme-value law with the rate lambda that solves E[exp(lambda s)] = 1; the
evidence of a document is the largest -log p over the sums of its r best normalised segments (Karlin and
Altschul). The score is a logistic curve of the evidence around the cut that separates the sample's other documents best.

Defined cases: null and empty texts and texts without letters have no segments and no evidence; texts of any
length are scanned whole; without labels of both classes there is no lexicon and every score is that of
no evidence; unlabelled documents are scored like all others; several labels of one id count as the highest;
an empty table gives no rows; repeated rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm.common import bounded, load, materialize, split_mod
from firnline.llm.quality import labelled_sample
from firnline.llm.textkern import LETTERS, Words, lower_chunks, mix

SAMPLE_PER_CLASS = 8000
PREFIXES = (4, 6)
PRIOR = 0.1
Z_MIN = 2.5
DRIFT = 1.0
THRESHOLD = 0.5
_CALIBRATION = 4  # one in so many sample documents calibrates, the others make the lexicon


def unit_hashes(data: np.ndarray, words: Words) -> list[np.ndarray]:
    """The hashes of each word's units, shortest first, as int64; a word no longer than a prefix has its own hash
    there. Prefixes are in code points."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    nth = np.searchsorted(lead, words.start)
    out = []
    for k in PREFIXES:
        stop = np.append(lead, len(data))[np.minimum(nth + k, len(lead))]
        part = Words.__new__(Words)
        part.start, part.end = words.start, np.minimum(stop, words.end)
        h = part.hashes(data)
        out.append(np.where(part.end < words.end, mix(h ^ np.uint64(k)), 0).view(np.int64))
    whole = words.hashes(data).view(np.int64)
    return [np.where(h == 0, whole, h) for h in out] + [whole]


@dataclass
class Model:
    keys: np.ndarray
    odds: np.ndarray
    rate: float = 1.0
    cut: float = 3.0  # -log p of 0.05

    def word_scores(self, data: np.ndarray, words: Words) -> np.ndarray:
        out = np.zeros(len(words.start))
        if len(self.keys):
            for h in unit_hashes(data, words):
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                out = np.where(self.keys[at] == h, self.odds[at], out)
        return out - DRIFT

    def evidence(self, segments: list[tuple[int, int, float]], n_words: int) -> float:
        """The best of the r highest segments, as -log p."""
        best, total, log_n = 0.0, 0.0, math.log(max(n_words, 1))
        for r, (_, _, s) in enumerate(sorted(segments, key=lambda x: -x[2]), 1):
            total += self.rate * s - log_n
            if total <= 0:
                break
            best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
        return best

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence - self.cut, -30, 30)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time. Only positive scores open a segment, so the
    scan goes over them and takes the sums between from prefix sums."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, left sum, right sum, link to a smaller left sum
    for i in np.flatnonzero(scores > 0).tolist():
        a, left, right = i, float(total[i]), float(total[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((a, i + 1, left, right, j))
                break
            a, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, right - left) for a, b, left, right, _ in stack]


def scan(column: pa.Array, model: Model) -> Iterator[tuple]:
    """(first row, end row, segments of each row, evidence of each row, bytes, offsets, words, word scores) by chunk."""
    for a, b, data, offsets in lower_chunks(column):
        words = Words(data, offsets, LETTERS)
        scores = model.word_scores(data, words)
        hot = np.unique(words.row[scores > 0])
        segments: list = [[] for _ in range(b - a)]
        evidence = [0.0] * (b - a)
        for r in hot.tolist():
            segments[r] = maximal_segments(scores[words.first[r] : words.first[r + 1]])
            evidence[r] = model.evidence(segments[r], int(words.count[r]))
        yield a, b, segments, evidence, data, offsets, words, scores


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, documents by label) of each batch."""
    for batch in batches:
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        for a, b, data, offsets in lower_chunks(batch.column("text")):
            words = Words(data, offsets, LETTERS)
            units = np.concatenate(unit_hashes(data, words))
            row = np.tile(words.row, len(PREFIXES) + 1)
            order = np.lexsort((units, row))
            units, row = units[order], row[order]
            new = np.ones(len(units), bool)
            new[1:] = (units[1:] != units[:-1]) | (row[1:] != row[:-1])
            kinds, back = np.unique(units[new], return_inverse=True)
            toxic = labels[a:b][row[new]] == 1
            t = np.bincount(back, toxic, len(kinds)).astype(np.int64)
            c = np.bincount(back, ~toxic, len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(t), pa.array(c)], ["unit", "t", "c"])


def log_odds(counts: DataFrame) -> DataFrame:
    """counts: unit, t, c. (unit, delta, z) with the informative Dirichlet prior."""
    total = counts.agg(F.sum("t").alias("nt"), F.sum("c").alias("nc")).first()
    nt, nc = float(total["nt"] or 0), float(total["nc"] or 0)
    prior, everything = PRIOR * (nt + nc), max(nt + nc, 1.0)
    a = F.lit(prior) * (F.col("t") + F.col("c")) / F.lit(everything)
    side = lambda y, n: F.log((F.col(y) + a) / (F.lit(n + prior) - F.col(y) - a))
    delta = side("t", nt) - side("c", nc)
    z = delta / F.sqrt(1 / (F.col("t") + a) + 1 / (F.col("c") + a))
    return counts.select("unit", delta.alias("delta"), z.alias("z"))


def _evidence_of(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label")
            for a, b, _, evidence, _, _, words, scores in scan(batch.column("text"), model):
                clean = label.slice(a, b - a).to_numpy(zero_copy_only=False) == 0
                kinds, n = np.unique(np.round(scores[clean[words.row]], 2), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [label.slice(a, b - a), pa.array(evidence, pa.float64()), pa.array([kinds.tolist()] + [None] * (b - a - 1), pa.list_(pa.float64())), pa.array([n.tolist()] + [None] * (b - a - 1), pa.list_(pa.int64()))],
                    ["label", "evidence", "kinds", "n"],
                )

    return run


def _rate(kinds: np.ndarray, n: np.ndarray) -> float:
    """lambda > 0 with E[exp(lambda s)] = 1 under the background, half an occurrence added to the highest score."""
    if not len(kinds) or kinds.max() <= 0:
        return 1.0
    p = n.astype(float)
    p[kinds.argmax()] += 0.5
    p /= p.sum()
    low, high = 1e-3, 60.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if np.dot(p, np.exp(middle * kinds)) < 1 else (low, middle)
    return low


def _cut(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The evidence that separates the classes with the least weight on the wrong side: halfway between two neighbouring
    values, in the widest gap of those that are equally good."""
    values = np.unique(x)
    if len(values) < 2:
        return Model.cut
    at = np.searchsorted(values, x)
    missed = np.cumsum(np.bincount(at, weight * (y == 1), len(values)))[:-1]  # toxic at or below the lower value
    alarms = np.bincount(at, weight * (y == 0), len(values))[::-1].cumsum()[::-1][1:]  # clean from the upper value on
    wrong = missed + alarms
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9 * weight.sum())
    gap = best[np.argmax((values[1:] - values[:-1])[best])]
    return float((values[gap] + values[gap + 1]) / 2)


def fit_toxicity(docs: DataFrame, labels: DataFrame, train, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """docs: doc_id, text. labels: doc_id, toxic. train: the rows of labels to learn from (a Column)."""
    sample, sizes = labelled_sample(labels, "toxic", per_class, train)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").filter(F.col("text").isNotNull())
    # one text of each id, however often it is repeated, and equal texts once, under their smallest id: the sample is
    # bounded, and the fit does not depend on the order of arrival
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    texts = texts.groupBy("label", "text").agg(F.min("doc_id").alias("doc_id"))
    texts = materialize(texts, "toxicity-sample")
    calibrates = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(_CALIBRATION)) == 0
    counts = texts.filter(~calibrates).select("label", "text").mapInArrow(_unit_counts, "unit long, t long, c long")
    odds = log_odds(materialize(counts.groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "toxicity-units"))
    kept = odds.filter(F.abs("z") >= Z_MIN).toPandas().sort_values("unit")  # of the sample's units
    model = Model(kept["unit"].to_numpy(np.int64), kept["delta"].to_numpy(float))
    held = texts.filter(calibrates).select("label", "text")
    ddl = "label int, evidence double, kinds array<double>, n array<long>"
    if len(model.keys):
        back = held.mapInArrow(_evidence_of(model), ddl).filter("kinds is not null")
        rows = back.select(F.explode(F.arrays_zip("kinds", "n")).alias("k")).groupBy("k.kinds").agg(F.sum("k.n").alias("n")).toPandas()
        model.rate = _rate(rows["kinds"].to_numpy(float), rows["n"].to_numpy(float))
    rows = held.mapInArrow(_evidence_of(model), ddl).select("label", "evidence").toPandas()
    y = rows["label"].to_numpy(float)
    if len(y) and 0 < y.mean() < 1:
        got = {c: (y == c).sum() for c in (0, 1)}
        weight = np.array([sizes.get(int(c), 0) / got[int(c)] for c in y])
        model.cut = _cut(rows["evidence"].to_numpy(float), y, weight)
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_passages and passages (start:end in code points of the lower-cased text, with the score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, segments, evidence, data, offsets, words, _ in scan(batch.column("text"), model):
                lead = np.cumsum((data & 0xC0) != 0x80)
                point = lambda at: int(lead[at - 1]) if at > 0 else 0
                spans, counts = [], []
                for r, found in enumerate(segments):
                    log_n = math.log(max(int(words.count[r]), 1))
                    found = [x for x in found if model.rate * x[2] > log_n]
                    counts.append(len(found))
                    if not found:
                        spans.append("")
                        continue
                    w = int(words.first[r])
                    origin = point(int(offsets[r]))
                    spans.append(",".join(f"{point(int(words.start[w + s])) - origin}:{point(int(words.end[w + e - 1])) - origin}:{v:.3f}" for s, e, v in found))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(model.score(np.array(evidence))), pa.array(counts, pa.int64()), pa.array(spans, pa.string())],
                    ["doc_id", "score", "n_passages", "passages"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, score double, n_passages long, passages string")


@bounded
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, split_mod("doc_id", 5) != 0)
    out = score_toxicity(docs, model)
    held_out = F.coalesce(split_mod("doc_id", 5) == 0, F.lit(False))
    return out.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "passages"
    )


@bounded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under THRESHOLD."""
    source, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = fit_toxicity(source, labels, split_mod("doc_id", 5) != 0)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                evidence = np.concatenate([np.array(x[3], float) for x in scan(batch.column("text"), model)])
                yield batch.filter(pa.array(model.score(evidence) < THRESHOLD))

    return docs.mapInArrow(clean, docs.schema)
