"""Near-duplicate detection with DartMinHash.

A text is the weighted set of its five-word shingles (lower-cased words between blanks; weight: how often the
shingle occurs). Darts are thrown at the plane of weight and rank of every element: unit layer l of element i is a
Poisson process along the rank, made from hashes of (i, l), each dart with a coordinate of the signature and a height
within its layer. A set keeps the darts under its weights up to a rank that suits its total weight, and of these
the earliest for each coordinate; coordinates left empty get darts of higher ranks. Two sets agree in a coordinate
with the probability of their weighted Jaccard similarity.

BANDS bands of ROWS coordinates make buckets. Candidate pairs are verified exactly: a link is a pair of different
texts with weighted Jaccard similarity of at least THRESHOLD. Classes are the connected components of links and
equal texts.

Groups of any size: equal texts are one node from the start. A bucket's center is its first node. Every node is
compared with the smallest of its centers, then with those of its other centers that are not yet in its component:
both linear in the buckets. Buckets whose nodes then lie in one component are settled. Among the nodes of the others, a
node's weight in shingles that any other of them has bounds its similarity to all of them; nodes that cannot reach the
threshold leave. The rest is compared with the node of the largest shared part in each bucket. What then lies outside
its bucket's largest component is compared with every node of another component that has one of its rarest shingles
(a prefix filter: without one of these a pair cannot reach the threshold), so that no candidate pair is left out whose
link could join two classes. Buckets that hold more than one in HOT of all rows (at most HOT buckets) are dealt over
SALTS tasks wherever rows meet by bucket. Texts move only where a sieve cannot rule out that they are wanted.

Defined cases: null texts and texts without words are in no bucket and are classes of their own, each row by its
id; texts of fewer than five words have one shingle of all their words; texts of any length are shingled whole;
repeated rows are copies and share a class; ties go to the smaller id; a null id is larger than all others and no
text's class if any of its copies has an id; an empty table gives no rows; other columns
are ignored by the classes and kept by the stage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.llm.common import Sieve, bounded, discard, free_names, load, materialize, quoted
from firnline.llm.textkern import NOT_SPACE, Words, chunks, lower_chunks, mix, shingles

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5  # a pair at the threshold misses all buckets with probability (1 - 0.8**5)**24 = 7e-5
_COORDINATES = BANDS * ROWS
HOT, SALTS = 2000, 32
_DARTS = _COORDINATES * (np.log(_COORDINATES) + 2)
_U64 = np.uint64
_UNIT = 1.0 / (1 << 53)


def _uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((h >> _U64(11)).astype(np.float64) + 0.5) * _UNIT


def weighted_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, element, weight) of the shingles of a chunk of lower-cased texts, sorted by row and element. Elements
    have 48 bits."""
    words = Words(data, offsets, NOT_SPACE)
    h, row = shingles(words.hashes(data), words.first, SHINGLE)
    key = (row.astype(_U64) << _U64(48)) | (h >> _U64(16))
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    weight = np.diff(np.append(at, len(key))).astype(np.float64)
    key = key[at]
    return (key >> _U64(48)).astype(np.int64), key & _U64((1 << 48) - 1), weight


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, coordinates: int = _COORDINATES) -> np.ndarray:
    """(n, coordinates): the identity of the earliest dart of each coordinate; 0 throughout for an empty set."""
    total = np.bincount(row, weight, n)
    rank = np.full((n, coordinates), np.inf)
    dart = np.zeros((n, coordinates), _U64)
    layers = np.ceil(weight).astype(np.int64)
    item = np.repeat(np.arange(len(row)), layers)
    layer = np.arange(len(item)) - np.repeat(np.cumsum(layers) - layers, layers)
    strip = mix(element[item] * _U64(0x9E3779B97F4A7C15) + layer.astype(_U64) + _U64(1))
    room = weight[item] - layer  # the part of the layer under the weight
    owner = row[item]
    at = np.zeros(len(item))
    limit = np.where(total > 0, _DARTS / np.maximum(total, 1e-12), 0.0)
    state = strip

    def advance(live: np.ndarray) -> None:
        state[live] = mix(state[live] + _U64(0xD1B54A32D192ED03))
        at[live] -= np.log(_uniform(state[live]))

    live, waiting = np.arange(len(item)), []
    advance(live)
    while True:
        near = at[live] <= limit[owner[live]]
        waiting.append(live[~near])
        live = live[near]
        if not len(live):
            unfilled = (total > 0) & ~np.isfinite(rank).all(axis=1)
            live, waiting = np.concatenate(waiting), []
            live = live[unfilled[owner[live]]]
            if not len(live):
                return dart
            limit[unfilled] *= 2
            continue
        h = state[live]
        extra = mix(h ^ _U64(0xA0761D6478BD642F))
        under = (extra >> _U64(40)).astype(np.float64) / (1 << 24) < room[live]
        coordinate = ((extra[under] & _U64(0xFFFFFFFF)) * _U64(coordinates) >> _U64(32)).astype(np.int64)
        slot, r, d = owner[live[under]] * coordinates + coordinate, at[live[under]], h[under]
        order = np.lexsort((r, slot))
        order = order[np.concatenate([[True], np.diff(slot[order]) > 0])] if len(order) else order
        slot, r, d = slot[order], r[order], d[order]
        better = r < rank.ravel()[slot]
        rank.ravel()[slot[better]], dart.ravel()[slot[better]] = r[better], d[better]
        advance(live)


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of each pair of texts."""
    both = pa.concat_arrays([left, right])
    n = len(left)
    row, element, weight = [], [], []
    texts = pc.dictionary_encode(pc.utf8_lower(both))
    for a, b, data, offsets in chunks(texts.dictionary):
        r, e, w = weighted_sets(data, offsets)
        row.append(r + a)
        element.append(e)
        weight.append(w)
    row, element, weight = map(np.concatenate, (row, element, weight))
    first = np.searchsorted(row, np.arange(len(texts.dictionary) + 1))
    total = np.bincount(row, weight, len(texts.dictionary))
    which = texts.indices.to_numpy(zero_copy_only=False)
    size = first[which + 1] - first[which]
    ends = np.cumsum(size)
    take = np.repeat(first[which] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    pair = np.repeat(np.concatenate([np.arange(n), np.arange(n)]), size)
    e, w = element[take], weight[take]
    order = np.lexsort((e, pair))
    pair, e, w = pair[order], e[order], w[order]
    same = np.flatnonzero((pair[1:] == pair[:-1]) & (e[1:] == e[:-1]))
    common = np.bincount(pair[same], np.minimum(w[same], w[same + 1]), n)
    union = total[which[:n]] + total[which[n:]] - common
    return common / np.maximum(union, 1e-300)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for a, b, data, offsets in lower_chunks(texts):
            n = b - a
            row, element, weight = weighted_sets(data, offsets)
            dart = signatures(row, element, weight, n).reshape(n, BANDS, ROWS)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U64), (n, BANDS)).copy()
            for k in range(ROWS):
                key = mix(key * _U64(0x9E3779B97F4A7C15) + dart[:, :, k])
            some = np.bincount(row, minlength=n) > 0
            raw = texts.slice(a, n).to_pylist()
            node = [hashlib.md5(t.encode()).digest() if ok else None for t, ok in zip(raw, some.tolist())]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(key.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([ids.slice(a, n), pa.array(node, pa.binary()), bands], ["doc_id", "node", "bands"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            j = similarities(part.column("text_u"), part.column("text_v"))
            yield part.select(["u", "v"]).filter(pa.array(j >= THRESHOLD - 1e-12))


def _node() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _links(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs (u, v) of nodes that pass the exact test."""
    u = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    v = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    rows = pairs.join(u, "u").join(v, "v").select("u", "v", "text_u", "text_v")
    return materialize(rows.mapInArrow(_verify, "u binary, v binary"), name)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): connected components by their smallest node. Labels spread along the edges and then jump
    to their own labels, so long chains take logarithmically many rounds; each round is a written table."""
    both = materialize(edges.select("u", "v").union(edges.select("v", "u")), "minhash-edges")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("component")), "minhash-labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        step = materialize(step, "minhash-step")
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        before, labels = labels, materialize(step.join(jump, "to").select("node", F.least("far", "to").alias("component"), "was"), "minhash-labels")
        discard(before, step)
        if labels.filter(F.col("component") != F.col("was")).isEmpty():
            discard(both)
            return labels.select("node", "component")


def _labelled(df: DataFrame, column: str, found: DataFrame, out: str) -> DataFrame:
    """df with the component of the nodes in a column; a node without links is its own."""
    f = found.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
    return df.join(f, df[column] == F.col("__n"), "left").withColumn(out, F.coalesce("__c", column)).drop("__n", "__c")


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only the graph of the components that the links join is searched."""
    edges = _labelled(_labelled(links, "u", found, "cu"), "v", found, "cv").filter(F.col("cu") != F.col("cv"))
    new = components(edges.select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct())
    moved = new.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = found.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    lone = new.join(found, "node", "left_anti").select("node", "component")
    return materialize(old.unionByName(lone), "minhash-found")


def _by_bucket(member: DataFrame, *values: Column) -> DataFrame:
    """A row per bucket, repeated for each of its salts, with values over its rows."""
    per = member.groupBy("bucket").agg(*values, F.max("salts").alias("salts"))
    return per.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def _unsettled(member: DataFrame) -> DataFrame:
    """The rows of buckets (bucket, salt, salts, node, component) that hold more than one component."""
    per = _by_bucket(member, F.min("component").alias("a"), F.max("component").alias("b"))
    return member.join(per.filter(F.col("a") != F.col("b")).select("bucket", "salt"), ["bucket", "salt"], "left_semi")


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """Distinct pairs, the smaller node first, that are not among the tested."""
    order = lambda df: df.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return materialize(order(pairs).distinct().join(order(tested), ["u", "v"], "left_anti"), "minhash-pairs")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in lower_chunks(batch.column("text")):
            row, element, weight = weighted_sets(data, offsets)
            at = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (element.view(np.int64), weight)]
            total = np.bincount(row, weight, b - a)
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), *lists, pa.array(total)], ["node", "element", "weight", "total"])


def _sets(texts: DataFrame) -> DataFrame:
    """(node, element, weight, total) with the shingles of a text as arrays."""
    return materialize(texts.mapInArrow(_elements, "node binary, element array<long>, weight array<double>, total double"), "minhash-elements")


def _exploded(sets: DataFrame, *columns: str) -> DataFrame:
    e = F.explode(F.arrays_zip("element", "weight")).alias("e")
    return sets.select("node", *columns, e).select("node", *columns, "e.element", "e.weight")


def _shared_weight(sets: DataFrame) -> DataFrame:
    """(node, part, total): a text's weight in shingles that some other of these texts has, and its whole weight."""
    rows = _exploded(sets)
    alone = rows.groupBy("element").agg(F.count("*").alias("n"), F.first("node").alias("node"), F.first("weight").alias("weight")).filter("n = 1")
    alone = alone.groupBy("node").agg(F.sum("weight").alias("alone"))
    return sets.select("node", "total").join(alone, "node", "left").select("node", (F.col("total") - F.coalesce("alone", F.lit(0.0))).alias("part"), "total")


def _prefix_pairs(minor: DataFrame, member: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v): for every minor node u all nodes v of other components that may reach the threshold with it. A common
    weight of at least a, the least that a partner of the smallest total in reach needs, must touch u's rarest shingles,
    taken until less than a is left; so v has one of them. minor: u, cu, pu, tu, smallest. member: node, component, part,
    total."""
    share = THRESHOLD / (1 + THRESHOLD)
    need = (share - 1e-9) * (F.col("tu") + F.greatest(F.col("smallest"), THRESHOLD * F.col("tu")))
    mine = _exploded(sets.join(minor.select(F.col("u").alias("node"), need.alias("need")), "node"), "total", "need")
    mine = materialize(mine.withColumnRenamed("node", "u"), "minhash-minor")
    postings = _exploded(sets).select(F.col("node").alias("v"), "element")
    postings = materialize(postings.join(mine.select("element").distinct(), "element", "left_semi"), "minhash-postings")
    often = postings.groupBy("element").agg(F.count("*").alias("n"))
    rare_first = W.partitionBy("u").orderBy("n", "element").rowsBetween(W.unboundedPreceding, -1)
    prefix = mine.join(often, "element").withColumn("before", F.coalesce(F.sum("weight").over(rare_first), F.lit(0.0)))
    prefix = prefix.filter((F.col("before") <= F.col("total") - F.col("need")) & (F.col("n") > 1)).select("u", "element")
    left = prefix.join(minor.select("u", "cu", "pu", "tu"), "u")
    right = member.select(F.col("node").alias("v"), F.col("component").alias("cv"), F.col("part").alias("pv"), F.col("total").alias("tv"))
    right = postings.join(right, "v")
    common = F.least("pu", "pv")
    fits = common >= (THRESHOLD - 1e-9) * (F.col("tu") + F.col("tv") - common)
    a, b = left.alias("a"), right.alias("b")
    return a.join(b, (F.col("a.element") == F.col("b.element")) & (F.col("cu") != F.col("cv")) & fits).select("u", "v")


def _within_reach(member: DataFrame) -> DataFrame:
    """Without the nodes that no text of their bucket can reach the threshold with. The common weight of a pair is at
    most the node's shared part p and the other's total; with the bucket's smallest total at least p, the similarity is
    at most p / (total + smallest - p), else at most p / total."""
    smallest = _by_bucket(member, F.min("total").alias("smallest"))
    p, t, least = F.col("part"), F.col("total"), F.col("smallest")
    bound = F.when(least >= p, p / (t + least - p)).otherwise(p / t)
    return member.join(smallest, ["bucket", "salt"]).filter(bound >= THRESHOLD - 1e-9).drop("smallest")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links). rows: doc_id, node (null: no words) of every input row; classes: node, class_id,
    keeper (whether the node holds the class's smallest id); links: u, v of the verified pairs found."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(slim.mapInArrow(_sign, "doc_id long, node binary, bands array<long>"), "minhash-signed")
    nodes = signed.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    nodes = materialize(nodes, "minhash-nodes")
    buckets = nodes.select(F.explode("bands").alias("bucket"), "node")
    centers = buckets.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("n")).filter("n > 1")
    centers = materialize(centers, "minhash-centers")
    # fewer than HOT buckets can hold more than one in HOT of the rows
    hot = centers.filter(F.col("n") * HOT > nodes.count() * BANDS).select(F.col("bucket").alias("hot"))
    salted = Sieve(centers, F.col("bucket")).marked(buckets, F.col("bucket"), "may").filter("may")
    salted = salted.join(F.broadcast(hot), F.col("bucket") == F.col("hot"), "left")
    salted = salted.withColumn("salt", F.when(F.col("hot").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.lit(SALTS))).cast("int"))
    each = centers.join(F.broadcast(hot), F.col("bucket") == F.col("hot"), "left").withColumn("salts", F.when(F.col("hot").isNull(), 1).otherwise(SALTS))
    each = each.select("bucket", "center", "salts", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    shared = materialize(salted.join(each, ["bucket", "salt"]).select("bucket", "salt", "salts", "node", "center"), "minhash-buckets")
    wanted = materialize(shared.select("node").distinct().join(nodes.select("node", "first_id"), "node"), "minhash-wanted")
    may = Sieve(wanted, F.xxhash64("first_id", "node")).marked(slim.withColumn("node", _node()), F.xxhash64("doc_id", "node"), "may")
    texts = may.filter("may").select("node", "doc_id", "text").join(
        wanted.select(F.col("node").alias("n"), "first_id").hint("shuffle_hash"),
        F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("n")),
    )
    texts = materialize(texts.groupBy("node").agg(F.first("text").alias("text")), "minhash-texts")

    # each node with the smallest of its centers
    rays = shared.filter(F.col("node") != F.col("center"))
    tested = materialize(rays.groupBy(F.col("node").alias("u")).agg(F.min("center").alias("v")), "minhash-nearest")
    links = _links(tested, texts, "minhash-links")
    found = components(links)

    # the other centers of nodes that are not yet in the center's component
    apart = _labelled(_labelled(rays, "node", found, "cn"), "center", found, "cc").filter(F.col("cn") != F.col("cc"))
    stars = apart.select(F.col("node").alias("u"), F.col("center").alias("v")).distinct()
    stars = materialize(stars.join(tested, ["u", "v"], "left_anti"), "minhash-stars")
    if not stars.isEmpty():
        more = _links(stars, texts, "minhash-links")
        if not more.isEmpty():
            links, found = links.union(more), _merged(found, more)
        tested = tested.union(stars)

    # buckets whose nodes are not yet in one component, without the nodes that can have no link there
    member = materialize(_unsettled(_labelled(shared.select("bucket", "salt", "salts", "node"), "node", found, "component")), "minhash-open")
    if not member.isEmpty():
        sets = _sets(member.select("node").distinct().join(texts, "node"))
        member = materialize(_unsettled(_within_reach(member.join(_shared_weight(sets), "node"))), "minhash-open")
        # against the bucket's node with the largest shared part, the least changed of many copies of one text
        best = _by_bucket(member, F.max(F.struct(F.col("part") / F.col("total"), "node"))["node"].alias("best"))
        rays = member.join(best, ["bucket", "salt"]).filter(F.col("node") != F.col("best")).select("node", "best", "component")
        rays = _labelled(rays, "best", found, "cb").filter(F.col("component") != F.col("cb"))
        pairs = _untested(rays.select(F.col("node").alias("u"), F.col("best").alias("v")), tested)
        more = _links(pairs, texts, "minhash-links")
        if not more.isEmpty():
            links, found = links.union(more), _merged(found, more)
        tested = tested.union(pairs)

        # every pair that is left
        member = _unsettled(_labelled(member.select("bucket", "salt", "salts", "node", "part", "total"), "node", found, "component"))
        member = materialize(member, "minhash-open")
        sizes = member.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.min("total").alias("smallest"), F.max("salts").alias("salts"))
        largest = _by_bucket(sizes, F.max(F.struct("n", "component"))["component"].alias("largest"), F.min("smallest").alias("smallest"))
        minor = member.join(largest, ["bucket", "salt"]).filter(F.col("component") != F.col("largest"))
        minor = minor.groupBy(F.col("node").alias("u")).agg(
            F.first("component").alias("cu"), F.first("part").alias("pu"), F.first("total").alias("tu"), F.min("smallest").alias("smallest")
        )
        nodes_left = member.select("node", "component", "part", "total").distinct()
        pairs = _untested(_prefix_pairs(materialize(minor, "minhash-minors"), nodes_left, sets), tested)
        if not pairs.isEmpty():
            more = _links(pairs, texts, "minhash-links")
            if not more.isEmpty():
                links, found = links.union(more), _merged(found, more)
    classes = _labelled(nodes.select("node", "first_id"), "node", found, "component")
    classes = materialize(classes, "minhash-classes")
    discard(nodes, centers, shared, wanted, texts)
    smallest = F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "node")
    least = classes.groupBy("component").agg(F.min(smallest).alias("keeper"))
    classes = classes.join(least, "component").select("node", F.col("keeper.first_id").alias("class_id"), (F.col("keeper.node") == F.col("node")).alias("keeper"))
    return signed.select("doc_id", "node"), classes, links


@bounded
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and class_id (the smallest id among its near copies) of every document."""
    rows, classes, _ = near_duplicates(load(spark, sf_dir, "documents"))
    return rows.join(classes.select("node", "class_id"), "node", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


@bounded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id; documents without words stay all. Only rows that
    may have to go (and rows that are repeated as a whole) move; all others stay where they are."""
    del spark, sf_dir
    signed, classes, _ = near_duplicates(docs)
    rows = signed.filter("node is not null").groupBy("doc_id", "node").agg(F.count("*").alias("n")).join(classes, "node")
    stays = F.col("keeper") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    marked = materialize(rows.withColumn("stays", stays).filter(~F.col("stays") | (F.col("n") > 1)).select("doc_id", "node", "stays"), "minhash-marked")
    own, node, may, stay, n = free_names(docs, "marked_id", "marked_node", "marked_may", "marked_stays", "own_node")
    columns = [quoted(c) for c in docs.columns]
    sieve = Sieve(marked, F.xxhash64("doc_id", "node"))
    dealt = sieve.marked(docs.withColumn(n, _node()), F.xxhash64(F.col("doc_id").cast("long"), F.col(n)), may)
    keys = marked.select(F.col("doc_id").alias(own), F.col("node").alias(node), F.col("stays").alias(stay))
    checked = dealt.filter(F.col(may)).join(keys, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(n) == F.col(node)), "left")
    out = dealt.filter(~F.col(may)).select(*columns).unionByName(checked.filter(F.col(stay).isNull()).select(*columns))
    if marked.filter("stays").isEmpty():
        return out
    one = checked.filter(F.col(stay)).groupBy(own, node).agg(F.first(F.struct(*columns)).alias(n)).select(f"{n}.*")
    return out.unionByName(one)


SQL = r"""
    with recursive d as (
        select doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\v\f\r]+'), lambda x: x <> '') as w
        from documents where text is not null
    ), s as (
        select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                              else [array_to_string(w, ' ')] end) as g
        from d where len(w) > 0
    ), c as (
        select doc_id, g, count(*) as k from s group by 1, 2
    ), t as (
        select doc_id, sum(k) as total from c group by 1
    ), p as (
        select a.doc_id as u, b.doc_id as v, sum(least(a.k, b.k)) as m
        from c a join c b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
    ), l as (
        select u, v from p join t x on x.doc_id = u join t y on y.doc_id = v where m >= 0.8 * (x.total + y.total - m)
    ), e as (
        select u, v from l union all select v, u from l
    ), r(node, label) as (
        select doc_id, doc_id from documents
        union
        select e.v, r.label from r join e on e.u = r.node where r.label < e.v
    )
    select node as doc_id, min(label) as class_id from r group by 1
"""
