"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the fractional copy number f = target / source size (in words). The whole
part is taken as it is; the fractional parts are rounded together: two documents exchange word mass at
random, in a way that keeps the expectation of each and the sum of both, until one of them is integral.
The other, still fractional, meets the next document. Groups of documents (source, hash bucket) are rounded
independently; the at most one residual of each group goes up a reduction tree of fixed fan-in, so no task
ever holds a whole source. About RESERVE documents of each source and size class (powers of two) wait for the
root (2 * RESERVE at most), which settles documents in falling order of size, each against all smaller ones as one
partner; what is left at the very end, rounded by its own probability, is a small one. A source misses its target by
less than that one document. Up to BROADCAST_SOURCES classes are joined by broadcast, more by a shuffle; that changes
the plan, not the result.

Rows that agree in id, text and source are counted first and rounded as one: of n rows with the fractional copy number
p, floor(n * p) take one copy more, and what is left of n * p is rounded like any document. Targets come from prefix
sums over sources in order, by ranges of sources, so that no task holds all of them.

Defined cases: null or wordless texts have size 0, are never taken (taken 0) and take no part in the
rounding; a null source is a source of its own, ordered last; repeated rows are separate rows, each with
its own copies; an empty table gives an empty result; all columns but the id, text and source are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.llm.common import bounded, free_names, load, materialize, quoted

WORD = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
GROUP_ROWS = 256  # documents of all sources in a hash bucket, on average
FAN_IN = 256  # residuals that meet at one node of the tree, per source
RESERVE = 32  # documents of each source and size class that are rounded at the root
BROADCAST_SOURCES = 10_000  # more sources than this are joined by a shuffle

SPLIT = 1 << 16  # repeated rows that a task writes from one counted row

_UNIT = "doc_id long, source string, size long, source_size long, target double, whole int, times long, full long, p double, bucket long, u double, h long"


def _ordered(df: DataFrame, order: list, sums: dict[str, Column], name: str) -> DataFrame:
    """df with running sums (without the row itself) along a total order: sums within ranges of rows, each sorted by
    itself, on top of the ranges' totals, of which there are as many as partitions."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)
    totals = ranged.groupBy("part").agg(*[F.sum(c).alias(f"sum_{k}") for k, c in sums.items()])
    parts = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    totals = totals.select(F.col("part").alias("at"), *[F.coalesce(F.sum(f"sum_{k}").over(parts), zero).alias(f"base_{k}") for k in sums])
    rows = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = ranged.select("*", *[F.coalesce(F.sum(c).over(rows), zero).alias(f"in_{k}") for k, c in sums.items()])
    out = inside.join(F.broadcast(totals), F.col("part") == F.col("at"))
    return out.select(*df.columns, *[(F.col(f"base_{k}") + F.col(f"in_{k}")).alias(k) for k in sums])


def source_targets(units: DataFrame) -> DataFrame:
    """(source, source_size, target): weights 1, 2, 3, repeating, share all words; a target stops at MAX_REPEAT
    times its source's size and the excess is shared by weight. This is water-filling: with sources ordered by
    cap/weight, a prefix is capped and the rest share the remaining words at one level. units: source, size, times."""
    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"))
    per = _ordered(per, [F.asc_nulls_last("source")], {"idx": F.lit(1).cast("long")}, "mix-sources")
    weights = F.array(*[F.lit(w).cast("long") for w in SOURCE_WEIGHTS])
    per = per.withColumn("w", F.element_at(weights, (F.col("idx") % len(SOURCE_WEIGHTS) + 1).cast("int")))
    per = per.withColumn("r", (MAX_REPEAT * F.col("source_size")).cast("double") / F.col("w"))
    per = materialize(_ordered(per, [F.asc("r"), F.asc("idx")], {"sizes": F.col("source_size"), "weights": F.col("w")}, "mix-ratios"), "mix-ordered")
    whole = per.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    at = (F.lit(float(whole["size"] or 0)) - (MAX_REPEAT * F.col("sizes")).cast("double")) / (F.lit(whole["w"] or 1) - F.col("weights"))
    level = per.filter(F.col("r") > at).agg(F.min(F.struct("r", "idx", at.alias("level")))["level"]).first()[0]
    cap = (MAX_REPEAT * F.col("source_size")).cast("double")
    return per.select("source", "source_size", (cap if level is None else F.least(cap, F.col("w") * F.lit(level))).alias("target"))


def pivot_run(size: np.ndarray, p: np.ndarray, u: np.ndarray, carry: tuple[float, float] | None = None):
    """Round fractional p (0 < p < 1) in order. Returns the rounded p, and the index that is still fractional
    (-1: the carried one, None: none) with its p. u: a uniform number for each row."""
    out = p.copy()
    held: int | None = None
    hp = hs = 0.0
    if carry is not None:
        held, (hp, hs) = -1, carry
    carried = None
    s_list, p_list, u_list = size.tolist(), p.tolist(), u.tolist()
    for i in range(len(s_list)):
        q, s = p_list[i], s_list[i]
        if held is None:
            held, hp, hs = i, q, s
            continue
        a, b = hp * hs, q * s  # word mass of the held and of the new document
        up = min(hs - a, b)  # mass that can go from the new one to the held one
        down = min(a, s - b)
        if u_list[i] * (up + down) < down:  # with probability down / (up + down) the held one gains
            full, empty = hs - a <= b, b <= hs - a
            hp, q = (1.0 if full else (a + up) / hs), (0.0 if empty else (b - up) / s)
        else:
            full, empty = s - b <= a, a <= s - b
            hp, q = (0.0 if empty else (a - down) / hs), (1.0 if full else (b + down) / s)
        if hp <= 0.0 or hp >= 1.0:
            if held == -1:
                carried = hp
            else:
                out[held] = hp
            if q <= 0.0 or q >= 1.0:
                out[i] = q
                held = None
            else:
                held, hp, hs = i, q, s
        else:
            out[i] = q
    if held is not None and held >= 0:
        out[held] = hp
    return out, held, hp, hs, carried


def _round_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, source): each run is one group; a run may go on in the next batch. The row that
    is still fractional at the end of its run keeps its p; all others leave with 0 or 1."""
    held_row: pa.RecordBatch | None = None
    held_key = None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
        source = batch.column("source")
        codes = source.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((bucket[1:] != bucket[:-1]) | (codes[1:] != codes[:-1])) + 1
        starts = np.concatenate([[0], cut, [n]])
        size = batch.column("size").to_numpy(zero_copy_only=False).astype(np.float64)
        p = batch.column("p").to_numpy(zero_copy_only=False)
        u = batch.column("u").to_numpy(zero_copy_only=False)
        new = p.copy()
        keep = np.ones(n, bool)
        p_at = batch.schema.get_field_index("p")

        def with_p(rows: pa.RecordBatch, values) -> pa.RecordBatch:
            return rows.set_column(p_at, rows.schema.field(p_at), pa.array(values, pa.float64()))

        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            key = (int(bucket[a]), source[a].as_py())
            carry = None
            if held_row is not None:
                if key == held_key:
                    carry = (held_row.column("p")[0].as_py(), float(held_row.column("size")[0].as_py()))
                else:
                    yield held_row
                    held_row = None
            out, held, hp, _hs, carried = pivot_run(size[a:b], p[a:b], u[a:b], carry)
            new[a:b] = out
            if carried is not None:
                yield with_p(held_row, [carried])
                held_row = None
            if held == -1:
                held_row = with_p(held_row, [hp])
            elif held is not None:
                held_row = with_p(batch.slice(a + held, 1), [hp])
                keep[a + held] = False
            held_key = key
        yield with_p(batch, new).filter(pa.array(keep))
    if held_row is not None:
        yield held_row


def round_root(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Round everything. The largest fractional document meets all smaller ones as one partner, whose
    probabilities move together by the same weights in either direction, so every expectation and the word mass
    are kept. Its size is bounded by FAN_IN residuals and the waiting documents."""
    order = np.argsort(-size, kind="stable")
    s, q, r = size[order].astype(float), p[order].copy(), u[order]
    for i in range(len(s)):
        draws = np.random.default_rng(int(r[i] * (1 << 52)))
        while 0.0 < q[i] < 1.0:
            rest = i + 1 + np.flatnonzero((q[i + 1 :] > 0) & (q[i + 1 :] < 1))
            if not len(rest):
                q[i] = 1.0 if draws.random() < q[i] else 0.0
                break
            spread = q[rest] * (1 - q[rest])
            most = (s[rest] * spread).sum() / np.maximum(q[rest], 1 - q[rest]).max()
            up, down = min((1 - q[i]) * s[i], most), min(q[i] * s[i], most)
            gains = draws.random() * (up + down) < down
            mass = up if gains else -down
            q[rest] -= mass * spread / (s[rest] * spread).sum()
            whole = mass == (1 - q[i]) * s[i] if gains else -mass == q[i] * s[i]
            q[i] = (1.0 if gains else 0.0) if whole else q[i] + mass / s[i]
            q[rest] = np.where(q[rest] < 1e-12, 0.0, np.where(q[rest] > 1 - 1e-12, 1.0, q[rest]))
    out = np.empty_like(q)
    out[order] = q
    return out


def _root(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["size", "doc_id", "h"], ascending=[False, True, True], ignore_index=True)
    pdf["p"] = round_root(pdf["size"].to_numpy(), pdf["p"].to_numpy(), pdf["u"].to_numpy())
    return pdf


def _round_level(df: DataFrame, name: str) -> DataFrame:
    dealt = df.repartition("bucket", F.xxhash64("source")).sortWithinPartitions("bucket", "source", "doc_id", "h")
    return materialize(dealt.mapInArrow(_round_stream, _UNIT), name)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 20) -> DataFrame:
    """One row per kind of rows that agree in id, text and source: doc_id, h (hash of the three), source, size,
    source_size, target, times (rows of the kind), whole (copies that each takes), more (how many take one more)."""
    units = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(id_col, text_col, source_col).alias("h"),
    )
    units = materialize(units.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("times")), "mix-units")
    n = units.count()
    targets = materialize(source_targets(units), "mix-targets")
    size_class = F.log2(F.greatest("size", F.lit(1)).cast("double")).cast("int")
    classes = materialize(units.groupBy("source", size_class.alias("size_class")).agg(F.count("*").alias("in_class")), "mix-classes")
    if classes.count() <= BROADCAST_SOURCES:
        targets, classes = F.broadcast(targets), F.broadcast(classes)
    buckets = max(1, -(-n // GROUP_ROWS))
    f = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0)
    rows = units.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    rows = rows.select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target", f.alias("f"), "d.times", F.col("d.h").alias("h"), size_class.alias("size_class"))
    rows = rows.alias("d").join(
        classes.alias("c"),
        F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.size_class") == F.col("c.size_class")),
    ).select("d.*", "c.in_class")
    uniform = lambda salt: F.pmod(F.xxhash64(F.lit(seed + salt), "h"), F.lit(1 << 52)) / float(1 << 52)
    rest = F.col("times") * (F.col("f") - F.floor("f"))  # copies beyond the whole ones
    rows = rows.select(
        "doc_id", "source", "size", "source_size", "target", F.floor("f").cast("int").alias("whole"), "times",
        F.floor(rest).cast("long").alias("full"), (rest - F.floor(rest)).alias("p"),
        F.pmod(F.xxhash64(F.lit(seed), "h"), F.lit(buckets)).cast("long").alias("bucket"),
        uniform(1).alias("u"), "h", "size_class", uniform(2).alias("wait"), (uniform(2) * F.col("in_class") < RESERVE).alias("waits"),
    )
    columns = [c.split()[0] for c in _UNIT.split(", ")]
    takes_part = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    done = [rows.filter(~takes_part).withColumn("p", F.lit(0.0)).select(*columns)]
    todo, level = rows.filter(takes_part), 0
    in_class = W.partitionBy("source", "size_class").orderBy("wait", "doc_id", "h")
    chosen = todo.filter("waits").withColumn("nth", F.row_number().over(in_class))
    waiting = chosen.filter(F.col("nth") <= 2 * RESERVE).withColumn("bucket", F.lit(0).cast("long")).select(*columns)
    todo = todo.filter(~F.col("waits")).select(*columns).unionByName(chosen.filter(F.col("nth") > 2 * RESERVE).select(*columns))
    while buckets > 1:
        out = _round_level(todo, f"mix-level{level}")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(out.filter(~open_))
        todo = out.filter(open_)
        buckets, level = -(-buckets // FAN_IN), level + 1
        todo = todo.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("long"))
    done.append(todo.unionByName(waiting).groupBy("source").applyInPandas(_root, _UNIT))
    all_rows = done[0]
    for part in done[1:]:
        all_rows = all_rows.unionByName(part)
    return all_rows.select("doc_id", "h", "source", "size", "source_size", "target", "times", "whole", (F.col("full") + F.col("p").cast("long")).alias("more"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 20
) -> DataFrame:
    """One row per input row: doc_id, h (hash of id, text and source), source, size, source_size, target, copies,
    taken (copies * size)."""
    kinds = mixed(docs, id_col, text_col, source_col, seed)
    # rows that are repeated often are written out by many tasks
    many = kinds.filter("times > 1").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / SPLIT))))
    many = many.repartition("h", "slice")
    first, last = F.col("slice") * SPLIT, F.least("times", (F.col("slice") + 1) * SPLIT) - 1
    many = many.withColumn("nth", F.explode(F.sequence(first, last))).drop("slice")
    rows = kinds.filter("times = 1").withColumn("nth", F.lit(0).cast("long")).unionByName(many)
    copies = (F.col("whole") + (F.col("nth") < F.col("more")).cast("int")).cast("int")
    return rows.select("doc_id", "h", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


@bounded
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@bounded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a document appears as often as the mix takes it (wordless rows stay).
    Rows that agree in id, text and source are one document whose copies add up."""
    del spark, sf_dir
    took = mixed(docs).withColumn("n", F.when(F.col("size") > 0, F.col("times") * F.col("whole") + F.col("more")).otherwise(F.col("times")))
    took = materialize(took.filter("n > 0").select("doc_id", "h", "times", "n"), "mix-took")
    own, h, n, nth = free_names(docs, "took_id", "took_h", "took_n", "nth")

    def taken(kinds: DataFrame) -> DataFrame:
        keys = kinds.select(F.col("doc_id").alias(own), F.col("h").alias(h), F.col("n").alias(n))
        return docs.join(keys, F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("doc_id", "text", "source") == F.col(h)))

    out = taken(took.filter("times = 1")).withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), n)))
    if not took.filter("times > 1").isEmpty():
        # one of the rows of each kind stands for all: which, nothing tells apart but other columns
        one = taken(took.filter("times > 1")).groupBy(own, h).agg(F.first(F.struct(*[F.col(quoted(c)) for c in docs.columns])).alias(nth), F.first(n).alias(n))
        one = one.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), n))).select(f"{nth}.*")
        return out.select(*[quoted(c) for c in docs.columns]).unionByName(one)
    return out.select(*[quoted(c) for c in docs.columns])
