"""Language ID by rank-order profiles: the most frequent character n-grams (1 to 3, over lower-cased letters with
blanks at word edges) of a document, in order, against each language's; the out-of-place distance sums how far
each n-gram is from its place in the profile, MISSING places if it isn't there.

The profiles are fitted on about SAMPLE_PER_LANG documents of each language, chosen by a hash of the id. There may be any
number of languages; the model holds PROFILE n-grams of each and is the only thing the driver sees.

Defined cases: a null text and a text without a letter get `und` with score 0; ties go to the first language by
name; texts of any length are profiled whole; with nothing to learn from every text is `und`; an empty table gives
no rows; repeated rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.llm.common import bounded, load, split_mod

PROFILE = 300
SAMPLE_PER_LANG = 2000
_CHUNK_CHARS = 1 << 20
_CHUNK_ROWS = 4096
_ROW_SHIFT = 50
_CELLS = 1 << 22  # (text, language) pairs that are summed at once


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x10000)])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """16-bit letter codes (0: no letter) of the lower-cased texts, a 0 before and after each; (codes, row of
    each). The blank after a text has the text's row."""
    low = [t.lower() for t in texts]
    cp = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = cp > 0xFFFF
    letter = np.zeros(len(cp), bool)
    letter[~wide] = _letters()[cp[~wide]]
    code = cp.astype(np.int64)
    if wide.any():
        kinds, back = np.unique(cp[wide], return_inverse=True)
        letter[wide] = np.array([chr(c).isalpha() for c in kinds])[back]
        code[wide] = ((cp[wide].astype(np.int64) * 0x9E3779B1) >> 13) & 0xFFFF | 1
    code[~letter] = 0
    sizes = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    return code, np.concatenate([[0], np.repeat(np.arange(len(low)), sizes)])


def gram_counts(texts: list[str], row_of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, count), sorted by row and gram. row_of: another number for each text (texts that share it are
    counted together)."""
    c, row = _codes(texts)
    if row_of is not None:
        row = row_of[row]
    high = row.astype(np.int64) << _ROW_SHIFT
    # of a letter with neighbours, so each n-gram's row is that of its letters
    one = c > 0
    two = one[:-1] | one[1:]
    keys = [(high + c)[one], (high[1:] + (1 << 48) + (c[:-1] << 16) + c[1:])[two]]
    three = one[1:-1]
    keys.append((high[1:-1] + (2 << 48) + (c[:-2] << 32) + (c[1:-1] << 16) + c[2:])[three])
    k = np.concatenate(keys)
    k.sort()
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    count = np.diff(np.append(at, len(k)))
    k = k[at]
    return k >> _ROW_SHIFT, k & ((1 << _ROW_SHIFT) - 1), count


def ranked(row: np.ndarray, gram: np.ndarray, count: np.ndarray, n_rows: int, top: int):
    """The top n-grams of each row by falling count, ties by code: (row, gram, rank)."""
    first = np.searchsorted(row, np.arange(n_rows + 1))
    often = np.bincount(row[count > 1], minlength=n_rows) >= top
    keep = (count > 1) | ~often[row]
    pos = np.arange(len(row)) - first[row]
    key = (row[keep] << 44) | ((0xFFFFF - np.minimum(count[keep], 0xFFFFF)) << 24) | pos[keep]
    key.sort()
    r = key >> 44
    start = np.searchsorted(r, np.arange(n_rows + 1))
    rank = np.arange(len(r)) - start[r]
    key, r, rank = key[rank < top], r[rank < top], rank[rank < top]
    return r, gram[first[r] + (key & 0xFFFFFF)], rank


def _text_chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    part, size, at = [], 0, 0
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= _CHUNK_CHARS or len(part) >= _CHUNK_ROWS:
            yield at, part
            part, size, at = [], 0, i + 1
    if part:
        yield at, part


def _count_langs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        code = {name: i for i, name in enumerate(names)}
        for at, part in _text_chunks(batch.column("text").to_pylist()):
            row_of = np.array([code[x] for x in langs[at : at + len(part)]], np.int64)
            lang, gram, count = gram_counts(part, row_of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names).take(pa.array(lang)), pa.array(gram), pa.array(count.astype(np.int64))], ["lang", "gram", "n"]
            )


def fit_profiles(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, top: int = PROFILE) -> dict[str, list[int]]:
    """lang -> its most frequent n-grams in order. docs: doc_id, text, lang of the rows to learn from."""
    known = docs.filter(F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    sizes = known.select("doc_id", "lang").distinct().groupBy("lang").agg(F.count("*").alias("__n")).withColumnRenamed("lang", "__lang")
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < F.least(F.lit(1.0), per_lang / F.col("__n")) * float(1 << 32)
    # a row per language: far less than the model, which goes to every worker as well
    texts = known.join(F.broadcast(sizes), F.col("lang") == F.col("__lang")).filter(chosen & F.col("text").isNotNull()).select("text", "lang")
    grams = texts.mapInArrow(_count_langs, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = grams.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    table = best.select("lang", "gram", "rank").toPandas().sort_values(["lang", "rank"])
    return {lang: part["gram"].tolist() for lang, part in table.groupby("lang", sort=True)}


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], top: int = PROFILE):
        self.top = top
        self.names = sorted(profiles)
        gram = np.array([g for name in self.names for g in profiles[name]], np.int64)
        lang = np.repeat(np.arange(len(self.names)), [len(profiles[name]) for name in self.names])
        place = np.concatenate([np.arange(len(profiles[name])) for name in self.names]) if self.names else np.zeros(0, np.int64)
        order = np.lexsort((lang, gram))
        # the languages, and the places there, of each n-gram
        self.grams, first = np.unique(gram[order], return_index=True)
        self.first = np.append(first, len(gram))
        self.lang, self.place = lang[order], place[order]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        most, names, scores = max(1, _CELLS // len(self.names)), [], [np.zeros(0)]
        for at in range(0, len(texts), most):
            best, score, used = self._nearest(texts[at : at + most])
            names += [self.names[b] if u else "und" for b, u in zip(best.tolist(), used.tolist())]
            scores.append(np.where(used > 0, np.clip(score, 0, 1), 0.0))
        return names, np.concatenate(scores)

    def _nearest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, k = len(texts), len(self.names)
        row, gram, rank = ranked(*gram_counts(texts), n, self.top)
        used = np.bincount(row, minlength=n)
        at = np.searchsorted(self.grams, gram)
        hit = self.grams[np.minimum(at, len(self.grams) - 1)] == gram if len(self.grams) else np.zeros(len(gram), bool)
        row, rank, at = row[hit], rank[hit], at[hit]
        size = self.first[at + 1] - self.first[at]
        ends = np.cumsum(size)
        post = np.repeat(self.first[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        # an n-gram that a profile lacks is `top` places away, so what each one found saves is summed
        saved = self.top - np.minimum(np.abs(self.place[post] - np.repeat(rank, size)), self.top)
        away = (used[:, None] * self.top).astype(float) - np.bincount(np.repeat(row, size) * k + self.lang[post], saved, minlength=n * k).reshape(n, k)
        best = away.argmin(axis=1)
        return best, 1 - away[np.arange(n), best] / np.maximum(used * self.top, 1), used


def identify(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles)
        for batch in batches:
            ids = batch.column("doc_id")
            for at, part in _text_chunks(batch.column("text").to_pylist()):
                names, score = model.predict(part)
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(part)), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, lang_pred string, score double")


@bounded
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    profiles = fit_profiles(docs.filter(split_mod("doc_id", 4) != 2))
    out = identify(docs, profiles)
    return out.select("doc_id", F.coalesce(split_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
