"""Exact top-k inner-product search with ball trees.

The vectors are dealt into shards.  A ball tree (centre and radius per node) is
built over each shard once and stored with it; a task reads it and answers a
block of queries by branch and bound: nodes are visited in the order of their upper bound q.c + |q| r, and a
node below the current kth score is skipped with all that it holds.

Shards are searched in waves, each eight times the one before.  The kth score
that the waves so far have reached for a query is the bound with which the next
wave begins, so most shards only open a few nodes.  Queries come in blocks of a
fixed size; a block, its bounds and its results are all that is ever sent to
every task or to the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stage

SCALE = 1024
SHARD_ROWS = 1 << 13
BLOCK_BYTES = 32 << 20
LEAF = 64
GROWTH = 8
EXACT = float(1 << 53)


@dataclass
class Tree:
    vectors: np.ndarray      # in leaf order
    ids: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    least: np.ndarray        # smallest id of each node
    span: list               # first and last row of each node
    child: list              # two nodes, or None


def build(vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> Tree:
    """Nodes are halved by rank along their widest dimension, so equal vectors
    are dealt out as well."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    at = np.arange(len(ids))
    centre, radius, least, span, child = [], [], [], [], []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        own = vectors[at[lo:hi]].astype(np.float64)
        node = len(span)
        if parent >= 0:
            child[parent][side] = node
        mid = own.mean(axis=0)
        centre.append(mid)
        radius.append(float(np.sqrt(((own - mid) ** 2).sum(axis=1).max())))
        least.append(int(ids[at[lo:hi]].min()))
        span.append((lo, hi))
        child.append(None)
        if hi - lo > leaf:
            wide = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if own.shape[1] else 0
            key = own[:, wide] if own.shape[1] else np.zeros(hi - lo)
            at[lo:hi] = at[lo:hi][np.argsort(key, kind="stable")]
            half = (lo + hi) // 2
            child[node] = [0, 0]
            todo += [(lo, half, node, 0), (half, hi, node, 1)]
    return Tree(vectors[at], ids[at], np.array(centre), np.array(radius), np.array(least), span, child)


def search(tree: Tree, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int,
           exact: bool) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) of the ``k`` best of the tree for each query, without
    its own id, as far as they are not below ``floor`` (score and id)."""
    q = queries.astype(np.float64)
    length = np.sqrt((q * q).sum(axis=1))
    bound = q @ tree.centre.T + length[:, None] * tree.radius[None, :]
    bound += 1e-9 * np.abs(bound) + 1e-6
    rows = tree.vectors.astype(np.float64) if exact else tree.vectors
    for i in range(len(own)):
        v, b, me = (q[i] if exact else queries[i]), bound[i], own[i]
        low, low_id = int(floor[i, 0]), int(floor[i, 1])
        best: list = []      # (score, -id), the worst first
        todo = [(-b[0], 0)]
        while todo:
            upper, node = heapq.heappop(todo)
            upper = np.floor(-upper)
            if upper < low:
                break        # no other node has more
            if upper == low and tree.least[node] > low_id:
                continue
            if tree.child[node]:
                for x in tree.child[node]:
                    if b[x] >= low:
                        heapq.heappush(todo, (-b[x], x))
                continue
            lo, hi = tree.span[node]
            score = rows[lo:hi] @ v
            for j in np.flatnonzero(score >= low).tolist():
                s, n = int(score[j]), int(tree.ids[lo + j])
                if n == me or (s, -n) < (low, -low_id):
                    continue
                heapq.heappush(best, (s, -n))
                if len(best) > k:
                    heapq.heappop(best)
                if len(best) == k:
                    low, low_id = max((low, -low_id), best[0])
                    low_id = -low_id
        for s, n in best:
            yield i, -n, s


_ARRAYS = {"ids": np.int64, "vectors": np.int64, "centre": np.float64, "radius": np.float64,
           "least": np.int64, "span": np.int64, "child": np.int64}
_TREES = "wave int, n int, " + ", ".join(f"{c} binary" for c in _ARRAYS)
_TREES_ARROW = pa.schema([("wave", pa.int32()), ("n", pa.int32())] + [(c, pa.binary()) for c in _ARRAYS])


def _stored(tree: Tree, wave: int, n: int) -> dict:
    child = np.array([c or (-1, -1) for c in tree.child], np.int64)
    arrays = {"ids": tree.ids, "vectors": tree.vectors, "centre": tree.centre, "radius": tree.radius,
              "least": tree.least, "span": np.array(tree.span, np.int64), "child": child}
    return {"wave": wave, "n": n} | {c: np.ascontiguousarray(arrays[c], of).tobytes() for c, of in _ARRAYS.items()}


def _loaded(row: dict) -> Tree:
    of = {c: np.frombuffer(row[c], kind) for c, kind in _ARRAYS.items()}
    n, rows, nodes = row["n"], len(of["ids"]), len(of["radius"])
    return Tree(of["vectors"].reshape(rows, n), of["ids"], of["centre"].reshape(nodes, n), of["radius"],
                of["least"], [tuple(s) for s in of["span"].reshape(nodes, 2).tolist()],
                [c if c[0] >= 0 else None for c in of["child"].reshape(nodes, 2).tolist()])


def _trees(shard_rows: int):
    """A row per shard with its tree.  Rows come sorted by wave and length of
    the vectors; a shard has rows of one of each, ``shard_rows`` at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, ids, vectors = None, [], []

        def grown() -> pa.RecordBatch:
            own = np.array(vectors, np.int64).reshape(len(ids), kind[1])
            return pa.RecordBatch.from_pylist([_stored(build(own, np.array(ids, np.int64)), *kind)], _TREES_ARROW)

        for batch in batches:
            for row in batch.to_pylist():
                now = row["wave"], row["n"]
                if ids and (now != kind or len(ids) == shard_rows):
                    yield grown()
                    ids, vectors = [], []
                kind = now
                ids.append(row["vec_id"])
                vectors.append(row["v"])
        if ids:
            yield grown()
    return run


def _searched(block, k: int):
    """The results of a task's shards for the queries of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, own, floor = block.value
        peak = float(np.abs(queries.astype(np.float64)).max(initial=0))
        for batch in batches:
            for row in batch.to_pylist():
                tree = _loaded(row)
                top = float(np.abs(tree.vectors.astype(np.float64)).max(initial=0))
                exact = peak * top * queries.shape[1] < EXACT  # else 64-bit integers
                found = list(search(tree, queries, own, floor, k, exact))
                if found:
                    i, n, s = (np.array(x, np.int64) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[i]), pa.array(n), pa.array(s)], ["query_id", "vec_id", "score"])
    return run


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, v (floor(1024 * component) as integers) and n (their number) of
    the usable rows."""
    def finite(x: Column) -> Column:
        y = x.cast("double")
        return F.coalesce(~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))), F.lit(False))

    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                          & F.forall("embedding", finite))
            .select(F.col("vec_id").cast("bigint").alias("vec_id"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"),
                    F.size("embedding").alias("n")))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(spark: SparkSession, vectors: DataFrame, k: int = 10, divisor: int = 100,
                shard_rows: int = SHARD_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` rows of ``vectors`` (vec_id, embedding) with the highest
    integer inner product with each query, ties to the smaller vec_id:
    query_id, rank (from 1), vec_id, score.

    Queries are the rows whose vec_id is divisible by ``divisor``.  Rows
    without a vec_id or a vector, or with a null, NaN or infinite component,
    take no part, and vectors are compared with those of their own length.  A
    query that repeats an id is asked once, with the smallest of its vectors;
    rows with the query's id are its own and no candidates, other repeated rows
    are candidates each.  Fewer than ``k`` candidates are all returned; an
    empty table gives an empty result.
    """
    usable = quantised(vectors)
    total = usable.count()
    n_shards = max(1, -(-total // shard_rows))
    waves, end = [1], 1
    while end < n_shards:
        end *= GROWTH
        waves.append(min(end, n_shards))
    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_shards))
    wave = sum((shard >= w).cast("int") for w in waves[:-1]) if len(waves) > 1 else F.lit(0)
    trees = stage(spark, usable.withColumn("shard", shard).withColumn("wave", wave.cast("int"))
                  .repartition(n_shards, "shard").sortWithinPartitions("wave", "n")
                  .select("wave", "n", "vec_id", "v").mapInArrow(_trees(shard_rows), _TREES),
                  "op7-trees", "wave", "n")
    asked = (usable.where(F.col("vec_id") % divisor == 0).groupBy("vec_id")
             .agg(F.min("v").alias("v")).withColumn("n", F.size("v")))
    asked = stage(spark, asked.repartitionByRange("n", "vec_id").sortWithinPartitions("n", "vec_id"),
                  "op7-queries")
    results = None
    for ids, queries in _blocks(asked, block_bytes):
        floor = np.tile(np.array([np.iinfo(np.int64).min, np.iinfo(np.int64).max]), (len(ids), 1))
        place = {n: i for i, n in enumerate(ids.tolist())}
        found = None
        for w in range(len(waves)):
            sent = spark.sparkContext.broadcast((queries, ids, floor))
            # The partition columns, so that only the shards of the wave and the length are read.
            own = trees.where((F.col("wave") == w) & (F.col("n") == queries.shape[1]))
            new = (own.select("n", *_ARRAYS)
                   .mapInArrow(_searched(sent, k), "query_id bigint, vec_id bigint, score bigint"))
            found = new if found is None else found.select(*new.columns).unionByName(new)
            found = stage(spark, _best(found, k), "op7-found")
            if w + 1 < len(waves):
                floor = floor.copy()
                for row in found.where(F.col("rank") == k).select("query_id", "score", "vec_id").collect():
                    floor[place[row[0]]] = row[1], row[2]
        results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return results.select("query_id", "rank", "vec_id", "score")


def _blocks(asked: DataFrame, block_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries of one length, in blocks of a bounded size."""
    ids: list = []
    rows: list = []
    for row in asked.select("vec_id", "v").toLocalIterator():
        v = np.array(row["v"], np.int64)
        if rows and (len(rows[0]) != len(v) or (len(rows) + 1) * max(1, v.nbytes) > block_bytes):
            yield np.array(ids, np.int64), np.stack(rows)
            ids, rows = [], []
        ids.append(row["vec_id"])
        rows.append(v)
    if rows:
        yield np.array(ids, np.int64), np.stack(rows)


ORACLE = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id,
           cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from usable q join usable c
      on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)),
ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
    from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
