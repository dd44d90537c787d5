"""Exact top-k search by multi-resolution segment statistics.

Vectors are integers floor(SCALE * x); the score is the inner product, ip = (|q|^2 + |x|^2 - d^2) / 2, so a lower
bound of the squared distance d^2 is an upper bound of the score. A vector is cut into s segments; with a segment's
mean m and deviation v, d^2 >= sum of length * ((mq - mx)^2 + (vq - vx)^2). Candidates go through LEVELS of ever
more segments, coarse to fine, against the query's current k-th best score; only survivors get exact products. Where
over _DENSE of a strip's pairs are left, finer levels are skipped and one plain product of the strip replaces the
search; on the given embeddings the bounds prune nothing and that is what runs.

Queries and vectors make a grid of blocks in one job: query rows that are equal in id and vector are one query with a
count, blocks hold QUERY_BLOCK queries on average, slabs SLAB vectors, dealt by row number, so no key decides how much a
cell gets. A cell's rows are sorted, queries first; a task holds the queries of one cell and streams its vectors. A
sample of SEED_ROWS vectors, the only rows that the driver sees, gives every query a first k-th best score, a true lower
bound of the final one, so that cells return few rows beyond the result.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; only vectors of
the query's length are its candidates; rows with the query's id are never its candidates; repeated candidate rows
each count; a repeated query row repeats its result; ties go to the smaller id; fewer than k candidates give as
many rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.llm.common import bounded, load, materialize

SCALE = 1024
K = 10
LEVELS = (4, 16)
QUERY_BLOCK = 16384
SLAB = 16384
SEED_ROWS = 4096
_CHUNK = 1024  # vectors scored at once
_STRIP = 512  # queries scored at once
_DENSE = 0.2  # share of survivors from which a dense product is cheaper than gathered ones


def usable(column: pa.Array, scale: float = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of whole numbers as doubles) for each length among the usable vectors."""
    present = ~column.is_null().to_numpy(zero_copy_only=False)
    off = column.offsets.to_numpy().astype(np.int64)
    values = column.values
    numbers = values.to_numpy(zero_copy_only=False).astype(np.float64)
    good = np.isfinite(numbers)
    bad = np.concatenate([[0], np.cumsum(~good)])
    length = np.diff(off)
    fit = present & (length > 0) & (bad[off[1:]] == bad[off[:-1]])
    for n in np.unique(length[fit]).tolist():
        rows = np.flatnonzero(fit & (length == n))
        yield rows, np.floor(scale * numbers[off[rows][:, None] + np.arange(n)])


def segment_statistics(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, 2 * parts): each segment's mean and deviation, times the square root of its length."""
    cuts = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
    size = np.diff(cuts)
    total = np.add.reduceat(x, cuts[:-1], axis=1)
    squares = np.add.reduceat(x * x, cuts[:-1], axis=1)
    mean = total / size
    spread = np.sqrt(np.maximum(squares / size - mean**2, 0))
    return np.hstack([mean, spread]) * np.sqrt(np.hstack([size, size]))


def lower_bound(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs of statistics: lower bounds of the vectors' own."""
    return (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * (q @ x.T)


class Search:
    """Running best k of a block of queries of one length."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.norm = (q * q).sum(1)
        self.levels = [segment_statistics(q, s) for s in LEVELS if s < q.shape[1]]
        self.floor = floor.astype(np.float64)
        self.found = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]  # query, score, id
        self.tested = self.total = 0

    def exact(self, a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.q[a], x[b])

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        norm = (x * x).sum(1)
        safe = float(np.abs(self.q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**52
        stats = [segment_statistics(x, s) for s in LEVELS if s < x.shape[1]]
        for at in range(0, len(self.q), _STRIP):
            strip = slice(at, at + _STRIP)
            floor = self.floor[strip]
            a = b = None
            for level, (sq, sx) in enumerate(zip(self.levels, stats)):
                if level == 0:
                    best = (self.norm[strip][:, None] + norm[None, :] - lower_bound(sq[strip], sx)) / 2
                    alive = best + 1e-9 * (np.abs(best) + 1) + 1e-6 >= floor[:, None]
                    a, b = np.nonzero(alive)
                else:
                    if len(a) > _DENSE * (len(floor) * len(x)):
                        continue
                    d = np.einsum("ij,ij->i", sq[at + a] - sx[b], sq[at + a] - sx[b])
                    best = (self.norm[at + a] + norm[b] - d) / 2
                    alive = best + 1e-9 * (np.abs(best) + 1) + 1e-6 >= floor[a]
                    a, b = a[alive], b[alive]
            if not safe:
                if a is None:
                    a, b = map(np.ravel, np.indices((len(floor), len(x))))
                score = np.array([int(sum(int(u) * int(v) for u, v in zip(self.q[at + i], x[j]))) for i, j in zip(a, b)], object)
                score = np.clip(score, -(2**63), 2**63 - 1).astype(np.int64) if len(score) else np.zeros(0)
            elif a is None or len(a) > _DENSE * (len(floor) * len(x)):
                dense = self.q[strip] @ x.T
                a, b = np.nonzero(dense >= floor[:, None])
                score = dense[a, b]
            else:
                score = self.exact(at + a, b, x)
            self.total += len(floor) * len(x)
            self.tested += len(a)
            keep = (score >= floor[a]) & (self.ids[at + a] != ids[b])
            self.merge(at + a[keep], score[keep], ids[b[keep]])

    def merge(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(query):
            return
        q = np.concatenate([self.found[0], query])
        s = np.concatenate([self.found[1], score])
        i = np.concatenate([self.found[2], ids])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, np.arange(len(self.q) + 1))
        place = np.arange(len(q)) - first[q]
        keep = place < self.k
        self.found = [q[keep], s[keep], i[keep]]
        last = place == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], s[last])


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _with_floor(seed_ids: np.ndarray, seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Adds to queries (block, number, times, vec_id, embedding) the k-th best score among the seed vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, floor = _numbers(batch.column("vec_id")), np.full(batch.num_rows, -np.inf)
            for rows, q in usable(batch.column("embedding")):
                own, x = seeds.get(q.shape[1], (seed_ids[:0], np.zeros((0, q.shape[1]))))
                search = Search(ids[rows], q, np.full(len(rows), -np.inf), k)
                for at in range(0, len(x), _CHUNK):
                    search.add(own[at : at + _CHUNK], x[at : at + _CHUNK])
                floor[rows] = search.floor
            yield batch.append_column("floor", pa.array(floor))

    return run


def _search_cells(k: int):
    """Rows sorted by (block, slab, kind), queries (kind 0) before vectors: each cell's best k of each of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, searches = None, [], {}

        def results() -> Iterator[pa.RecordBatch]:
            for number, times, search in searches.values():
                q, s, i = search.found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[q]), pa.array(times[q]), pa.array(search.ids[q]), pa.array(i), pa.array(s.astype(np.int64))],
                    ["number", "times", "query_id", "vec_id", "score"],
                )

        def prepared(parts: list[pa.RecordBatch]) -> dict:
            found: dict[int, list] = {}
            for part in parts:
                columns = [_numbers(part.column(c)) for c in ("number", "times", "vec_id", "floor")]
                for rows, q in usable(part.column("embedding")):
                    found.setdefault(q.shape[1], []).append((*(c[rows] for c in columns), q))
            out = {}
            for n, groups in found.items():
                number, times, ids, floor, q = (np.concatenate(c) for c in zip(*groups))
                out[n] = number, times, Search(ids, q, floor, k)
            return out

        for batch in batches:
            block, slab, kind = (_numbers(batch.column(c)) for c in ("block", "slab", "kind"))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(slab) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if cell != (block[a], slab[a]):
                    yield from results()
                    cell, waiting, searches = (block[a], slab[a]), [], {}
                part = batch.slice(a, b - a)
                if kind[a] == 0:
                    waiting.append(part)
                    continue
                if waiting:
                    searches, waiting = prepared(waiting), []
                ids = _numbers(part.column("vec_id"))
                for rows, x in usable(part.column("embedding")):
                    if x.shape[1] in searches:
                        for at in range(0, len(x), _CHUNK):
                            searches[x.shape[1]][2].add(ids[rows[at : at + _CHUNK]], x[at : at + _CHUNK])
        yield from results()

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products for every row that is_query holds for.
    vectors: vec_id, embedding."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id is not null")
    asked = vectors.filter(is_query).filter("embedding is not null").groupBy("vec_id", "embedding").agg(F.count("*").alias("times"))
    asked = materialize(asked, "topk-asked")
    n_blocks, n_slabs = max(1, -(-asked.count() // QUERY_BLOCK)), max(1, -(-vectors.count() // SLAB))
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id", "embedding"), F.lit(n_blocks)).cast("int")
    in_block = W.partitionBy("block").orderBy("vec_id", "embedding")  # QUERY_BLOCK rows on average, all different
    number = F.col("block").cast("long") * (1 << 40) + F.row_number().over(in_block)
    queries = asked.withColumn("block", block).select("block", number.alias("number"), "times", "vec_id", "embedding")
    seed = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEED_ROWS).toArrow().combine_chunks()
    seeds, seed_ids = {}, _numbers(pa.chunked_array(seed.column("vec_id")).combine_chunks())
    if len(seed_ids):
        seeds = {x.shape[1]: (seed_ids[rows], x) for rows, x in usable(pa.chunked_array(seed.column("embedding")).combine_chunks())}
    ddl = "block int, number long, times long, vec_id long, embedding array<float>, floor double"
    ddl = ddl.replace("array<float>", dict(vectors.dtypes)["embedding"])
    queries = materialize(queries.mapInArrow(_with_floor(seed_ids, seeds, k), ddl), "topk-queries")
    slabs, blocks = F.sequence(F.lit(0), F.lit(n_slabs - 1)), F.sequence(F.lit(0), F.lit(n_blocks - 1))
    nothing = F.lit(0).cast("long")
    left = queries.select("block", F.explode(slabs).alias("slab"), F.lit(0).alias("kind"), "number", "times", "vec_id", "embedding", "floor")
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(n_slabs)).cast("int")
    right = vectors.withColumn("slab", dealt).select(
        F.explode(blocks).alias("block"), "slab", F.lit(1).alias("kind"), nothing.alias("number"), nothing.alias("times"), "vec_id", "embedding", F.lit(0.0).alias("floor")
    )
    cells = left.unionByName(right).repartition(n_blocks * n_slabs, "block", "slab").sortWithinPartitions("block", "slab", "kind")
    rows = cells.mapInArrow(_search_cells(k), "number long, times long, query_id long, vec_id long, score long")
    place = W.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    best = rows.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    best = best.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@bounded
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL = """
    with v as (
        select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
        from embeddings where embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select q.vec_id as query_id, c.vec_id as vec_id,
               cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
        from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0
    ), r as (
        select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
    )
    select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""
