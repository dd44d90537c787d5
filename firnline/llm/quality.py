"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on about SAMPLE_PER_CLASS labelled documents of each class, chosen by a hash of the id and
weighted back to the classes' true shares. Statistics use the text alone.

Defined cases: null and empty texts have all-zero statistics and get the trees' score for them; texts of any length
count whole; without usable labels every score is the prior 0.5; documents without a label are scored like all
others; several labels of one id count as the highest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm import boosting
from firnline.llm.common import bounded, class_sizes, load, sample_per_class, split_mod
from firnline.llm.textkern import NOT_NEWLINE, NOT_SPACE, Words, chunks, shingles

SAMPLE_PER_CLASS = 8000
THRESHOLD = 0.3

_KINDS = ("space", "newline", "upper", "lower", "digit", "period", "comma", "bang", "bracket", "quote", "symbol", "lead", "tail", "control")
_KIND_OF = np.full(256, _KINDS.index("control"), np.int64)
for _name, _members in (
    ("space", b" \t"), ("newline", b"\n\r"), ("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)), ("symbol", b"#$%&*+/<=>@\\^_`|~"),
    ("period", b"."), ("comma", b",;:-"), ("bang", b"!?"), ("bracket", b"()[]{}"), ("quote", b"\"'"), ("lead", range(192, 256)), ("tail", range(128, 192)),
):
    _KIND_OF[list(_members)] = _KINDS.index(_name)

FEATURES = (
    "log_bytes", "log_words", "word_mean", "word_sdev", "word_max", *(f"share_{k}" for k in _KINDS), "upper_of_letters",
    "punctuated_words", "symbol_words", "upper_words", "distinct_words", "top_word", "distinct_five", "log_lines",
    "distinct_lines", "line_mean", "entropy",
)


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, and how often the most frequent one occurs."""
    key = (h >> np.uint64(13)) | (row.astype(np.uint64) << np.uint64(51))
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    owner = (key[at] >> np.uint64(51)).astype(np.int64)
    count = np.diff(np.append(at, len(key)))
    most = np.zeros(n)
    np.maximum.at(most, owner, count)
    return np.bincount(owner, minlength=n), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, FEATURES) of a chunk of UTF-8 texts."""
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * 16 + _KIND_OF[data], minlength=n * 16).reshape(n, 16)[:, : len(_KINDS)].astype(float)
    share = kinds / np.maximum(size, 1)[:, None]
    words = Words(data, offsets, NOT_SPACE)
    count = np.maximum(words.count, 1)
    length = (words.end - words.start).astype(float)
    total = np.bincount(words.row, length, n)
    mean = total / count
    sdev = np.sqrt(np.maximum(np.bincount(words.row, length**2, n) / count - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, words.row, length)
    last, first = _KIND_OF[data[words.end - 1]], _KIND_OF[data[words.start]]
    second = _KIND_OF[data[np.minimum(words.start + 1, words.end - 1)]]
    part = lambda mask: np.bincount(words.row, mask, n) / count
    of = _KINDS.index
    h = words.hashes(data)
    distinct, top = _distinct(words.row, h, n)
    five, five_row = shingles(h, words.first, 5)
    distinct_five, _ = _distinct(five_row, five, n)
    lines = Words(data, offsets, NOT_NEWLINE)
    distinct_lines, _ = _distinct(lines.row, lines.hashes(data), n)
    n_lines = np.maximum(lines.count, 1)
    letters = kinds[:, of("upper")] + kinds[:, of("lower")]
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.where(share > 0, share * np.log2(share), 0).sum(1)
    return np.column_stack([
        np.log1p(size), np.log1p(words.count), mean, sdev, longest, share, kinds[:, of("upper")] / np.maximum(letters, 1),
        part((last == of("period")) | (last == of("comma")) | (last == of("bang"))), part((last == of("symbol")) | (first == of("symbol"))),
        part((first == of("upper")) & (second == of("upper"))), distinct / count, top / count,
        distinct_five / np.maximum(np.bincount(five_row, minlength=n), 1), np.log1p(lines.count), distinct_lines / n_lines, size / n_lines, entropy,
    ])


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column("text")):
            x = statistics(data, offsets)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("label").slice(a, b - a), flat], ["doc_id", "label", "x"])


def labelled_sample(labels: DataFrame, column: str, per_class: int, train) -> tuple[DataFrame, dict[int, int]]:
    """About per_class ids of each class among the rows to learn from, and the classes' sizes."""
    known = labels.filter(train & F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    sizes = class_sizes(known, "label")
    return sample_per_class(known, "doc_id", "label", per_class, sizes), sizes


def fit_quality(docs: DataFrame, labels: DataFrame, train, per_class: int = SAMPLE_PER_CLASS) -> boosting.Trees:
    """docs: doc_id, text. labels: doc_id, quality. train: the rows of labels to learn from (a Column)."""
    sample, sizes = labelled_sample(labels, "quality", per_class, train)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    # one row of each id, however often it is repeated, so that what the driver gets is bounded by the sample
    rows = texts.mapInArrow(_statistics_of, "doc_id long, label int, x array<double>").groupBy("doc_id", "label").agg(F.min("x").alias("x")).toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    y = rows["label"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # the fit does not depend on the order of arrival
    x, y = x[order], y[order]
    got = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.array([sizes.get(int(c), 0) / got[int(c)] for c in y]) if len(y) else np.zeros(0)
    return boosting.fit(x, y, weight * (len(y) / weight.sum()) if len(y) else weight)


def score_quality(docs: DataFrame, model: boosting.Trees) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                p = model.predict(statistics(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(p)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


@bounded
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = fit_quality(docs, labels, split_mod("doc_id", 5) != 0)
    out = score_quality(docs, model)
    held_out = F.coalesce(split_mod("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
