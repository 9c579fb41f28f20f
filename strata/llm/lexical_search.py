"""Ranked lexical search with two trees.

A score is an inner product: an item has a weight per term, a document a
saturated frequency per term, both non-negative integers.  Documents come in
shards.  A task turns a shard into vectors over the items' terms and builds a
tree over them, and one over the items; a node of either holds the maxima of
the coordinates below it.  For a pair of nodes the product of their maxima
bounds every score below; where it does not reach the weakest kth score of the
node's items, the whole batch of pairs is skipped.  The pairs that remain at
the leaves are scored, those with the highest bound first, so that the kth
scores rise early.

Shards are searched in waves, each sixteen times the one before; a wave begins
with the kth scores that the waves before it have reached.  Items come in blocks
of a bounded size: a block, its kth scores and the counts of its terms are all
that is sent to every task or to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import slices, stage, words

BLOCK_TERMS = 1 << 13    # distinct terms of a block of items
BLOCK_ITEMS = 1 << 10
SHARD_DOCS = 1 << 11
SLICE = 4 << 20
GROWTH = 16
ITEM_LEAF, DOC_LEAF = 4, 32
BATCH = 64               # leaf pairs scored between two looks at the bounds
SPLITS = 256             # coordinates by which a tree may split
CELLS = 1 << 23          # of the vectors a task holds at once
LAST = np.iinfo(np.int64).max

# ASCII letters in lower case, digits and all bytes of other characters stay; the rest parts terms.
_TERM = np.full(256, 0x20, np.uint8)
_TERM[0x80:] = np.arange(0x80, 0x100)
for _lo, _hi, _shift in (("0", "9", 0), ("a", "z", 0), ("A", "Z", 32)):
    _TERM[ord(_lo):ord(_hi) + 1] = np.arange(ord(_lo), ord(_hi) + 1) + _shift


def terms(text: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct terms of ``text``, the index of each term of each row, and
    the offsets of the rows in that index."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    _, offsets, data = text.buffers()
    at = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and len(text) else np.empty(0, np.uint8)
    parted = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(at - at[0]), pa.py_buffer(_TERM[raw]))
    return words(parted)


def _counted(vocabulary: dict[bytes, int]):
    """Shards of documents, a row each: ids and numbers of terms of its
    documents, the frequencies of the vocabulary's terms in them (by document),
    and what the shard adds to the corpus counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for most in slices(batch, "text", SLICE):
                for lo in range(0, most.num_rows, SHARD_DOCS):
                    part = most.slice(lo, SHARD_DOCS)
                    distinct, index, offsets = terms(part.column("text"))
                    known = np.array([vocabulary.get(w, -1) for w in distinct], np.int64)
                    term = known[index] if len(distinct) else np.empty(0, np.int64)
                    doc = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                    key, tf = np.unique((doc * len(vocabulary) + term)[term >= 0], return_counts=True)
                    doc, term = key // max(1, len(vocabulary)), key % max(1, len(vocabulary))
                    held = np.bincount(term, minlength=len(vocabulary))
                    n = np.diff(offsets)
                    row = {"ids": part.column("doc_id").fill_null(LAST).to_numpy().astype(np.int64).tobytes(),
                           "n": n.astype(np.int64).tobytes(),
                           "doc": doc.astype(np.uint16).tobytes(), "term": term.astype(np.uint32).tobytes(),
                           "tf": tf.astype(np.int32).tobytes(),
                           "with_terms": int((n > 0).sum()), "all_terms": int(n.sum()),
                           "held": [{"term": int(t), "df": int(held[t])} for t in np.flatnonzero(held)]}
                    yield pa.RecordBatch.from_pylist([row], _SHARD)
    return run


_SHARD = pa.schema([(c, pa.binary()) for c in ("ids", "n", "doc", "term", "tf")]
                   + [("with_terms", pa.int64()), ("all_terms", pa.int64()),
                      ("held", pa.list_(pa.struct([("term", pa.int64()), ("df", pa.int64())])))])
_SHARD_SQL = ("ids binary, n binary, doc binary, term binary, tf binary, with_terms bigint, all_terms bigint, "
              "held array<struct<term: bigint, df: bigint>>")


@dataclass
class Tree:
    order: np.ndarray        # rows in leaf order
    span: np.ndarray         # first and last row of each node, the children after their parent
    child: np.ndarray        # the first of a node's two children, or 0
    maxima: np.ndarray       # of the coordinates of each node's rows


def _halves(own: np.ndarray) -> tuple[np.ndarray, int]:
    """The rows ordered from one of two clusters to the other, and where the
    second begins; neither has under an eighth of the rows."""
    middle = own.mean(axis=0)
    one = own[np.argmin(own @ middle)]
    two = own[np.argmin(own @ one)]
    for _ in range(2):
        nearer = own @ (one - two) > 0
        if nearer.all() or not nearer.any():
            break
        one, two = own[nearer].mean(axis=0), own[~nearer].mean(axis=0)
    side = own @ (one - two)
    eighth = max(1, len(own) // 8)
    return np.argsort(-side, kind="stable"), int(np.clip((side > 0).sum(), eighth, len(own) - eighth))


def build(rows: np.ndarray, weight: np.ndarray, leaf: int) -> Tree:
    """A tree over ``rows``: a node is parted into two clusters by direction,
    along the coordinates that vary most by ``weight``."""
    splits = np.argsort(-(rows.std(axis=0) * weight), kind="stable")[:SPLITS]
    narrow = rows[:, splits] * weight[splits]
    narrow /= np.maximum(1e-9, np.sqrt((narrow * narrow).sum(axis=1)))[:, None]
    order = np.arange(len(rows))
    span, child = [(0, len(rows))], [0]
    todo = [0]
    while todo:
        node = todo.pop()
        lo, hi = span[node]
        if hi - lo <= leaf:
            continue
        by, first = _halves(narrow[order[lo:hi]])
        order[lo:hi] = order[lo:hi][by]
        child[node] = len(span)
        todo += [len(span), len(span) + 1]
        span += [(lo, lo + first), (lo + first, hi)]
        child += [0, 0]
    maxima = np.zeros((len(span), rows.shape[1]))
    for node in range(len(span) - 1, -1, -1):
        lo, hi = span[node]
        if child[node]:
            np.maximum(maxima[child[node]], maxima[child[node] + 1], out=maxima[node])
        elif hi > lo:
            rows[order[lo:hi]].max(axis=0, out=maxima[node])
    return Tree(order, np.array(span), np.array(child), maxima)


class _Best:
    """The k best (score, id) of each item, and the floor below which nothing counts."""

    def __init__(self, floor: np.ndarray, k: int):
        self.low, self.low_id = floor[:, 0].copy(), floor[:, 1].copy()
        self.k = k
        self.found: list[np.ndarray] = [np.empty((0, 2), np.int64) for _ in range(len(floor))]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        ok = (scores > self.low[item]) | ((scores == self.low[item]) & (ids <= self.low_id[item]))
        ok &= scores > 0
        if not ok.any():
            return
        own = np.concatenate([self.found[item], np.stack([scores[ok], ids[ok]], axis=1)])
        own = own[np.lexsort((own[:, 1], -own[:, 0]))][:self.k]
        self.found[item] = own
        if len(own) == self.k:
            last = own[-1]
            if last[0] > self.low[item] or (last[0] == self.low[item] and last[1] < self.low_id[item]):
                self.low[item], self.low_id[item] = last


def search(items: Tree, weights: np.ndarray, docs: Tree, vectors: np.ndarray, ids: np.ndarray,
           best: _Best) -> int:
    """Adds to ``best`` the shard's documents; returns how many pairs of an item
    and a document were scored."""
    least = np.array([ids[docs.order[lo:hi]].min() for lo, hi in docs.span])
    has = [np.flatnonzero(m) for m in items.maxima]

    def weakest(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weakest kth score of the nodes' items, and the largest id that may tie with it."""
        low = np.array([best.low[items.order[lo:hi]].min() for lo, hi in items.span[node]])
        tie = np.array([best.low_id[items.order[lo:hi]].max() for lo, hi in items.span[node]])
        return low, tie

    def reach(i: np.ndarray, d: np.ndarray, bound: np.ndarray) -> np.ndarray:
        nodes, back = np.unique(i, return_inverse=True)
        low, tie = (x[back.reshape(-1)] for x in weakest(nodes))
        return (bound > 0) & ((bound > low) | ((bound == low) & (least[d] <= tie)))

    def bounds(i: np.ndarray, d: np.ndarray) -> np.ndarray:
        out = np.empty(len(i))
        for node in np.unique(i).tolist():
            own = np.flatnonzero(i == node)
            out[own] = docs.maxima[d[own][:, None], has[node]] @ items.maxima[node][has[node]]
        return out

    i, d = np.zeros(1, np.int64), np.zeros(1, np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(i):
        bound = bounds(i, d)
        ok = reach(i, d, bound)
        i, d, bound = i[ok], d[ok], bound[ok]
        end = (items.child[i] == 0) & (docs.child[d] == 0)
        leaves.append((i[end], d[end], bound[end]))
        i, d = i[~end], d[~end]
        # The node with more rows below it is opened, unless it is a leaf.
        open_doc = (docs.child[d] > 0) & ((items.child[i] == 0) | (docs.span[d, 1] - docs.span[d, 0]
                                                                  >= items.span[i, 1] - items.span[i, 0]))
        di, dd, ii, id_ = i[open_doc], docs.child[d[open_doc]], items.child[i[~open_doc]], d[~open_doc]
        i, d = np.concatenate([di, di, ii, ii + 1]), np.concatenate([dd, dd + 1, id_, id_])
    i, d, bound = (np.concatenate(x) for x in zip(*leaves, strict=True))
    order = np.argsort(-bound, kind="stable")
    i, d, bound = i[order], d[order], bound[order]
    scored, at = 0, 0
    while at < len(i):
        part = slice(at, at + BATCH)
        ok = np.flatnonzero(reach(i[part], d[part], bound[part])) + at
        for node, leaf in zip(i[ok].tolist(), d[ok].tolist(), strict=True):
            who = items.order[slice(*items.span[node])]
            rows = docs.order[slice(*docs.span[leaf])]
            scores = (vectors[rows[:, None], has[node]] @ weights[who[:, None], has[node]].T).astype(np.int64)
            scored += scores.size
            for column, item in enumerate(who.tolist()):
                best.add(item, scores[:, column], ids[rows])
        at += BATCH
    return scored


def vector(tf: np.ndarray, n: np.ndarray, count: int, total: int) -> np.ndarray:
    """The saturated frequencies: integers, as they are in 64-bit arithmetic."""
    m = 10 + 90 * n * count // max(1, total)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _searched(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, weights, floor, count, total = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                best = _Best(floor, k)
                _search_shard(row, weights, count, total, best)
                i = np.repeat(np.arange(len(item_ids)), [len(f) for f in best.found])
                found = np.concatenate(best.found)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item_ids[i]), pa.array(found[:, 1]), pa.array(found[:, 0])],
                        ["item_id", "doc_id", "score"])
    return run


def _search_shard(row: dict, weights: np.ndarray, count: int, total: int, best: _Best) -> None:
    """A shard's documents, as many at once as their vectors have room."""
    ids, n = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["n"], np.int64)
    doc, term = np.frombuffer(row["doc"], np.uint16), np.frombuffer(row["term"], np.uint32)
    used, column = np.unique(term, return_inverse=True)
    if not len(used):
        return
    value = vector(np.frombuffer(row["tf"], np.int32).astype(np.int64), n[doc], count, total)
    own = weights[:, used]
    tree = build(own, np.ones(len(used)), ITEM_LEAF)
    room = max(1, CELLS // len(used))
    for lo in range(0, len(ids), room):
        part = slice(*np.searchsorted(doc, [lo, lo + room]))
        vectors = np.zeros((min(room, len(ids) - lo), len(used)))
        vectors[doc[part].astype(np.int64) - lo, column.reshape(-1)[part]] = value[part]
        search(tree, own, build(vectors, own.max(axis=0), DOC_LEAF), vectors, ids[lo:lo + room], best)


_FOUND = "item_id bigint, doc_id bigint, score bigint"


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame, block_terms: int) -> Iterator[tuple[np.ndarray, list[list[bytes]]]]:
    """Items (id and distinct terms) in blocks of a bounded number of items and terms."""
    ids: list[int] = []
    held: list[list[bytes]] = []
    known: set[bytes] = set()
    for row in items.toLocalIterator():
        own = sorted(terms(pa.array([row["text"]], pa.string()))[0])
        if ids and (len(known.union(own)) > block_terms or len(ids) >= BLOCK_ITEMS):
            yield np.array(ids, np.int64), held
            ids, held, known = [], [], set()
        ids.append(row["item_id"])
        held.append(own)
        known.update(own)
    if ids:
        yield np.array(ids, np.int64), held


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10,
           block_terms: int = BLOCK_TERMS, growth: int = GROWTH) -> DataFrame:
    """The ``k`` documents of ``docs`` (doc_id, text) with the highest score
    above 0 for each item of ``items`` (item_id, text): item_id, rank (from 1),
    doc_id, score; ties to the smaller doc_id.

    Terms are runs of ASCII letters and digits and of all other characters
    outside ASCII; A-Z are lower-cased.  Null and empty texts have no term; an
    item without terms has no result, a document without terms none either and
    is not counted.  Each of repeated rows is a document of its own.  A null
    doc_id comes after all others.  Items without an item_id are not asked; one
    whose id repeats is asked once, with the smallest of its texts.  An empty
    table gives an empty result.  Other columns are ignored.  Products and
    sums are below 2**53, so exact, up to 300,000 distinct terms of an item.
    """
    asked = (items.where(F.col("item_id").isNotNull()).groupBy(F.col("item_id").cast("bigint").alias("item_id"))
             .agg(F.min(F.col("text").cast("string")).alias("text")))
    asked = stage(spark, asked.repartitionByRange("item_id").sortWithinPartitions("item_id"), "op11-items")
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    results = None
    for ids, held in _blocks(asked, block_terms):
        found = _block(spark, own, ids, held, k, growth)
        if found is not None:
            results = found if results is None else results.unionByName(found)
    if results is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return results.select("item_id", "rank",
                          F.when(F.col("doc_id") != LAST, F.col("doc_id")).alias("doc_id"), "score")


def _block(spark: SparkSession, docs: DataFrame, ids: np.ndarray, held: list[list[bytes]], k: int,
           growth: int) -> DataFrame | None:
    vocabulary = {w: t for t, w in enumerate(sorted(set().union(*held)))}
    if not vocabulary:
        return None
    shards = stage(spark, docs.mapInArrow(_counted(vocabulary), _SHARD_SQL), "op11-shards")
    n_shards, count, total = shards.agg(F.count(F.lit(1)), F.sum("with_terms"), F.sum("all_terms")).first()
    if not total:
        return None
    df = dict(shards.select(F.explode("held").alias("t")).groupBy("t.term").agg(F.sum("t.df")).collect())
    weights = np.zeros((len(ids), len(vocabulary)))
    for i, own in enumerate(held):
        for w in own:
            t = vocabulary[w]
            weights[i, t] = math.floor(1000 * math.log((2 * count + 2) / (2 * df.get(t, 0) + 1)))
    waves, end = [0], 1
    while end < n_shards:
        waves.append(end)
        end *= growth
    place = F.pmod(F.xxhash64("ids", "n"), F.lit(n_shards))
    wave = sum((place >= w).cast("int") for w in waves[1:]) if len(waves) > 1 else F.lit(0)
    floor = np.stack([np.zeros(len(ids), np.int64), np.full(len(ids), LAST)], axis=1)
    number = {n: i for i, n in enumerate(ids.tolist())}
    found = None
    for w in range(len(waves)):
        sent = spark.sparkContext.broadcast((ids, weights, floor, count, total))
        new = (shards.where(wave == w).select("ids", "n", "doc", "term", "tf")
               .mapInArrow(_searched(sent, k), _FOUND))
        found = new if found is None else found.select(*new.columns).unionByName(new)
        found = stage(spark, _best(found, k), "op11-found")
        if w + 1 < len(waves):
            floor = floor.copy()
            for row in found.where(F.col("rank") == k).select("item_id", "score", "doc_id").collect():
                floor[number[row[0]]] = row[1], row[2]
    return found


ORACLE = r"""
with words as (
    select doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents),
totals as (
    select cast(sum((len(terms) > 0)::int) as bigint) as n_docs, cast(sum(len(terms)) as bigint) as n_terms
    from words),
items as (
    select distinct item_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark),
freq as (
    select doc_id, n, term, count(*) as tf
    from (select doc_id, cast(len(terms) as bigint) as n, unnest(terms) as term from words)
    where term in (select term from items)
    group by doc_id, n, term),
df as (select term, count(*) as df from freq group by term),
parts as (
    select f.doc_id, f.term,
           cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / (2 * df.df + 1))) as bigint)
           * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (10 + (90 * f.n * n_docs) // n_terms))) as score
    from freq f join df using (term) cross join totals),
scored as (
    select i.item_id, p.doc_id, cast(sum(p.score) as bigint) as score
    from items i join parts p using (term) group by all having sum(p.score) > 0),
ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
           doc_id, score
    from scored)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
