"""Near-duplicate documents by b-bit MinHash.

Documents are sets of five-word shingles.  A signature keeps the low bits of
128 minima, packed; the whole minima, four at a time, give 32 band keys.
Documents with a band key in common are candidates; the matching low bits,
corrected for chance collisions, estimate their similarity and sort out the
clearly different; the rest is confirmed on the full sets.

Groups of copies never become all their pairs.  Equal sets are one *class*, the
node of the graph; documents are its labels.  In a hub round each class is held
against one hub, of those of its buckets the one it shares most bands with;
what hubs join is one component and needs no more pairs inside.  Only where a
bucket still spans components are members outside its largest component held
against the others, chunk by chunk: signatures of 1024 minima say which members
may have a link, and the sets of these are compared in the same chunks, which
return only links that join two components, fewer than they have members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (U64, WHITE, mixed, remove, slices, stage, staged_inside, without_rows,
                               words)
from strata.llm.components import components

SHINGLE = 5
PERCENT = 75             # links have 100 * intersection >= 75 * union
N_MIN, ROWS = 128, 4     # minima; minima of a band
LOW_BITS = 4             # kept of each minimum
WIDE = 1024              # minima of the signatures that settle open buckets
DEVIATIONS = 4.5         # an estimate may be so many standard deviations below a link
HUB_ROUNDS = 8           # at most; a round that joins few ends them
FEW = 0.05               # of the members that a hub round compares
CHUNK = 512
SLICE = 4 << 20

_ODD = mixed(np.arange(1, WIDE + 1, dtype=U64)) | U64(1)
_POWERS = mixed(np.arange(1001, 1001 + SHINGLE, dtype=U64)) | U64(1)


def shingle_sets(text: pa.Array) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles; fewer words
    than a shingle has are one shingle, no words none."""
    distinct, index, offsets = words(text)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w.lower()) for w in distinct), U64, len(distinct))[index] \
        if distinct else np.empty(0, U64)
    with np.errstate(over="ignore"):
        n = max(0, len(h) - SHINGLE + 1)
        run = np.zeros(n, U64)
        for k in range(SHINGLE):
            run += mixed(h[k:k + n] + U64(k)) * _POWERS[k]
        run = mixed(run)
        out = []
        for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
            if hi - lo >= SHINGLE:
                out.append(np.unique(run[lo:hi - SHINGLE + 1]))
            elif hi > lo:
                short = (mixed(h[lo:hi] + np.arange(hi - lo, dtype=U64)) * _POWERS[:hi - lo]).sum(dtype=U64)
                out.append(mixed(np.array([short + U64(hi - lo)], U64)))
            else:
                out.append(np.empty(0, U64))
    return out


def minima(shingles: np.ndarray, n: int = N_MIN) -> np.ndarray:
    low = np.full(n, np.iinfo(U64).max, U64)
    step = max(1, (1 << 17) // n)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), step):
            part = shingles[at:at + step]
            np.minimum(low, (part[None, :] * _ODD[:n, None]).min(axis=1), out=low)
    return low


def _packed(low: np.ndarray) -> bytes:
    """The low bits of the minima, two to a byte."""
    bits = (mixed(low) & U64((1 << LOW_BITS) - 1)).astype(np.uint8)
    return (bits[0::2] << 4 | bits[1::2]).tobytes()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            n, digest, packed, bands = [], [], [], []
            for shingles in shingle_sets(part.column("text")):
                n.append(len(shingles))
                if not len(shingles):
                    digest.append(None)
                    packed.append(None)
                    bands.append(None)
                    continue
                low = minima(shingles)
                digest.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                packed.append(_packed(low))
                of = low.reshape(-1, ROWS)
                key = np.arange(len(of), dtype=U64)
                for k in range(ROWS):
                    key = mixed(key + mixed(of[:, k]))
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.array(n, pa.int64()),
                 pa.array(digest, pa.binary()), pa.array(packed, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_shingles", "digest", "packed", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            yield pa.RecordBatch.from_arrays(
                [part.column("node"),
                 pa.array([s.tobytes() for s in shingle_sets(part.column("text"))], pa.binary())],
                ["node", "shingles"])


def _nibbles(packed: list[bytes]) -> np.ndarray:
    b = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    return np.concatenate([b >> 4, b & 15], axis=1)


CHANCE = 2.0 ** -LOW_BITS    # with which different minima agree in their low bits


def similarity(match: np.ndarray, n: int = N_MIN) -> np.ndarray:
    """Estimate from the number of matching low bits of ``n``."""
    return (match / n - CHANCE) / (1 - CHANCE)


def _least(n: int) -> float:
    """The smallest estimate, from ``n`` minima, of what may be a link."""
    link = PERCENT / 100
    agree = CHANCE + (1 - CHANCE) * link
    return link - DEVIATIONS * (agree * (1 - agree) / n) ** 0.5 / (1 - CHANCE)


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = batch.column("shingles")
        wide = [_packed(minima(np.frombuffer(sets[i].as_buffer(), U64), WIDE))
                for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(wide, pa.binary())],
                                         ["node", "wide"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of candidate pairs (a, b, pa, pb) those whose estimate allows a link."""
    for batch in batches:
        if batch.num_rows:
            x, y = (_nibbles(batch.column(c).to_pylist()) for c in ("pa", "pb"))
            near = similarity((x == y).sum(axis=1)) >= _least(N_MIN)
            yield batch.select(["a", "b"]).filter(pa.array(near))


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets, sorted arrays, are similar enough."""
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b, sa, sb) those whose full sets are similar enough."""
    for batch in batches:
        ok = [_linked(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64))
              for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


_PAIR = "a bigint, b bigint"


class _Search:
    """The state between rounds: classes, their buckets, sets and labels."""

    def __init__(self, spark: SparkSession, classes: DataFrame, docs: DataFrame):
        self.spark = spark
        self.classes = classes
        band = F.explode("bands").alias("band")
        every = classes.select("node", band)
        shared = every.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = stage(spark, shared.select("band"), "op8-shared")
        self.members = stage(spark, every.join(shared, "band"), "op8-members")
        involved = stage(spark, self.members.select("node").distinct(), "op8-involved")
        filled = docs.where(F.col("text").rlike(rf"[^{WHITE}]"))
        texts = filled.join(involved, filled["doc_id"] == involved["node"]).select("node", "text")
        other = stage(spark, classes.where("not by_id").select("node", "of").join(involved, "node"), "op8-other")
        if not other.isEmpty():      # classes that no doc_id stands for
            texts = texts.unionByName(filled.join(
                other, filled["doc_id"].eqNullSafe(other["of.doc_id"]) & (filled["key"] == other["of.key"]))
                .select("node", "text"))
        self.sets = stage(spark, texts.dropDuplicates(["node"])
                          .mapInArrow(_sets, "node bigint, shingles binary"), "op8-sets")
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def labelled(self) -> DataFrame:
        """The members of buckets that still span more than one component."""
        if self.labels is None:
            now = self.members.withColumn("label", F.col("node"))
        else:
            now = (self.members.join(self.labels, "node", "left")
                   .withColumn("label", F.coalesce("label", "node")))
        open_ = stage(self.spark, now.groupBy("band")
                      .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                      .where("lo < hi").select("band"), "op8-spanning")
        return now.join(open_, "band")

    def confirm(self, pairs: DataFrame, name: str) -> DataFrame:
        """Links among distinct ``pairs`` (a, b)."""
        pairs = stage(self.spark, pairs, f"op8-{name}")
        first = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        second = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        return stage(self.spark, pairs.join(first, "a").join(second, "b")
                     .select("a", "b", "sa", "sb").mapInArrow(_confirmed, _PAIR), f"op8-{name}-links")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        first = self.classes.select(F.col("node").alias("a"), F.col("packed").alias("pa"))
        second = self.classes.select(F.col("node").alias("b"), F.col("packed").alias("pb"))
        return (pairs.join(first, "a").join(second, "b").select("a", "b", "pa", "pb")
                .mapInArrow(_alike, _PAIR))

    def add(self, links: DataFrame) -> None:
        self.links = links if self.links is None else self.links.unionByName(links)
        self.labels = stage(self.spark, components(self.spark, self.links, "op8"), "op8-labels")


def _hub_round(search: _Search, turn: int) -> bool:
    """Every class against one hub of another component: each bucket has a hub,
    its smallest class first and another one in later turns, and a class takes
    the one of most of its buckets.  Says whether another round is worth it."""
    now = stage(search.spark, search.labelled(), f"op8-open{turn}")
    by = F.col("node") if turn == 0 else F.xxhash64(F.lit(turn), "node")
    hub = stage(search.spark, now.groupBy("band").agg(
        F.min(F.struct(by.alias("by"), F.col("node").alias("hub"), F.col("label").alias("at"))).alias("h"))
        .select("band", "h.hub", "h.at"), f"op8-hubs{turn}")
    met = (now.join(hub, "band").where(F.col("label") != F.col("at"))
           .groupBy("node", "hub").agg(F.count(F.lit(1)).alias("bands"))
           .groupBy("node").agg(F.max(F.struct("bands", "hub")).alias("most")))
    pairs = stage(search.spark, met.select(F.least("node", "most.hub").alias("a"),
                                           F.greatest("node", "most.hub").alias("b")).distinct(),
                  f"op8-met{turn}")
    links = search.confirm(search.estimated(pairs), f"hub{turn}")
    found, compared = links.count(), pairs.count()
    if found:
        search.add(links)
    return found > FEW * compared


def _places(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that come sorted by place (band, i, j), place by place: the rows to
    hold against the others (``out`` 2), then these."""
    at, rows = None, []
    for batch in batches:
        for row in batch.select([*_PLACE, "out", "node", "label", *columns]).to_pylist():
            place = row["band"], row["i"], row["j"]
            if place != at:
                if rows:
                    yield at, rows
                at, rows = place, []
            rows.append(row)
    if rows:
        yield at, rows


_PLACE = ["band", "i", "j"]


def _alike_in(band: int, rows: list[dict]) -> tuple[list[dict], list[dict], np.ndarray]:
    """The rows to hold against the others, these, and which pairs of the two
    may be links: of different labels, similar by their wide signatures, in the
    first band that they have in common.  Two members outside the largest
    component (``out`` 1) meet twice and count once."""
    outside = [r for r in rows if r["out"] == 2]
    members = [r for r in rows if r["out"] < 2]
    if not outside or not members:
        return outside, members, np.zeros((len(outside), len(members)), bool)
    near = np.zeros((len(outside), len(members)), bool)
    bits, keys = _nibbles([r["wide"] for r in outside]), np.array([r["bands"] for r in outside], np.int64)
    label, node = (np.array([r[c] for r in outside], np.int64) for c in ("label", "node"))
    least = _least(WIDE)
    for k, row in enumerate(members):
        own = np.array(row["bands"], np.int64)
        near[:, k] = ((similarity((bits == _nibbles([row["wide"]])).sum(axis=1), WIDE) >= least)
                      & (label != row["label"]) & (own[(keys == own).argmax(axis=1)] == band)
                      & ((node > row["node"]) | (row["out"] == 0)))
    return outside, members, near


_MEMBER = "band bigint, i int, j int, out int, node bigint, label bigint"


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each place that may have a link in it."""
    names = [*_PLACE, "out", "node", "label"]
    for place, rows in _places(batches, ("wide", "bands")):
        outside, members, near = _alike_in(place[0], rows)
        kept = [outside[k] for k in np.flatnonzero(near.any(axis=1))] \
            + [members[k] for k in np.flatnonzero(near.any(axis=0))]
        yield pa.RecordBatch.from_pylist([{c: r[c] for c in names} for r in kept], _MEMBER_ARROW)


_MEMBER_ARROW = pa.schema([("band", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("out", pa.int32()),
                           ("node", pa.int64()), ("label", pa.int64())])


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each place that join two components of it, by full sets."""
    for place, rows in _places(batches, ("wide", "bands", "shingles")):
        outside, members, near = _alike_in(place[0], rows)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        a, b = [], []
        for o, m in zip(*np.nonzero(near), strict=True):
            x, y = outside[o], members[m]
            one, two = find(x["label"]), find(y["label"])
            if one != two and _linked(np.frombuffer(x["shingles"], U64), np.frombuffer(y["shingles"], U64)):
                root[one] = two
                a.append(min(x["node"], y["node"]))
                b.append(max(x["node"], y["node"]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _rest(search: _Search) -> None:
    """All remaining links between components in a bucket.  The members of a
    bucket are dealt into chunks i, those outside its largest component into
    chunks j; a task compares the members of a place (band, i, j), two bounded
    chunks."""
    spark = search.spark
    now = stage(spark, search.labelled(), "op8-open")
    if now.isEmpty():
        return
    wide = stage(spark, search.sets.join(now.select("node").distinct(), "node")
                 .mapInArrow(_widened, "node bigint, wide binary")
                 .join(search.classes.select("node", "bands"), "node"), "op8-wide")
    count = now.groupBy("band", "label").agg(F.count(F.lit(1)).alias("m"))
    deal = stage(spark, count.groupBy("band")
                 .agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("n"))
                 .select("band", F.col("top.label").alias("top"),
                         F.ceil(F.col("n") / CHUNK).cast("int").alias("own_chunks"),
                         F.ceil((F.col("n") - F.col("top.m")) / CHUNK).cast("int").alias("out_chunks")),
                 "op8-deal")
    member = now.select("band", "node", "label").join(deal, "band")

    def chunk(of: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(of)), F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    def by_place(rows: DataFrame) -> DataFrame:
        return rows.repartition(*_PLACE).sortWithinPartitions(*_PLACE, F.desc("out"))

    own = member.select("band", chunk("own_chunks").alias("i"), every("out_chunks").alias("j"),
                        (F.col("label") != F.col("top")).cast("int").alias("out"), "node", "label")
    out = member.where("label != top").select(
        "band", every("own_chunks").alias("i"), chunk("out_chunks").alias("j"),
        F.lit(2).alias("out"), "node", "label")
    suspects = stage(spark, by_place(own.unionByName(out).join(wide, "node")).mapInArrow(_suspects, _MEMBER),
                     "op8-suspects")
    links = by_place(suspects.join(wide, "node").join(search.sets, "node")).mapInArrow(_joining, _PAIR)
    search.add(stage(spark, links, "op8-joining"))


def _graph(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, key (the hash of its text), n_shingles, label
    (its component, null for the empty set) and component_id."""
    with staged_inside() as made:
        found = _searched(spark, docs)
    remove(spark, made, "op8-rows", "op8-known")
    return found


def _searched(spark: SparkSession, docs: DataFrame) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                      F.xxhash64(F.col("text").cast("string")).alias("key"),
                      F.col("text").cast("string").alias("text"))
    signed = stage(spark, own.mapInArrow(_signed, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("key", T.LongType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("packed", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType()))])), "op8-signed")
    # A doc_id that several classes have is one document; one that a single class has can stand for it.
    several = stage(spark, signed.where("doc_id is not null").groupBy("doc_id")
                    .agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
                    .where("lo < hi").select("doc_id"), "op8-several")
    least = F.least(F.lit(0).cast("bigint"), F.lit(signed.agg(F.min("doc_id")).first()[0]))
    classes = signed.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "key")).alias("of"),
        F.first("packed").alias("packed"), F.first("bands").alias("bands"))
    classes = classes.join(several.select(F.col("doc_id").alias("first"), F.lit(True).alias("several")),
                           "first", "left")
    by_id = F.col("first").isNotNull() & F.col("several").isNull()
    classes = stage(spark, classes.withColumn("by_id", by_id).withColumn(
        "node", F.when(by_id, F.col("first")).otherwise(least - 1 - F.monotonically_increasing_id()))
        .drop("several"), "op8-classes")
    rows = stage(spark, signed.select("doc_id", "key", "n_shingles", "digest")
                 .join(classes.select("digest", "node"), "digest", "left").drop("digest"), "op8-rows")
    search = _Search(spark, classes, own)
    own_nodes = rows.where("node is not null").join(several, "doc_id").select("doc_id", "node").distinct()
    same = stage(spark, own_nodes.join(own_nodes.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id")
                 .where("node > a").select("a", F.col("node").alias("b")).distinct(), "op8-same")
    if not same.isEmpty():
        search.add(same)
    for turn in range(HUB_ROUNDS):
        if not _hub_round(search, turn):
            break
    _rest(search)
    label = classes.select("node", "first")
    label = label.withColumn("label", F.col("node")) if search.labels is None else \
        label.join(search.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    label = stage(spark, label, "op8-label")
    least = stage(spark, label.groupBy("label").agg(F.min("first").alias("component_id"),
                                                    F.count(F.lit(1)).alias("n")).where("n > 1"), "op8-least")
    known = stage(spark, label.join(least.drop("n"), "label", "left")
                  .select("node", "label", F.when(F.col("component_id").isNull(), F.col("first"))
                          .otherwise(F.col("component_id")).alias("component_id")), "op8-known")
    return (rows.join(known, "node", "left")
            .select("doc_id", "key", "n_shingles", "label",
                    F.when(F.col("node").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id,
    kept (doc_id is its component's smallest).

    Words are runs of characters other than white space, A-Z lower-cased; the
    set of a document has its distinct five-word shingles, or its whole
    sequence of words if that is shorter.  Documents are linked at a Jaccard
    similarity of 0.75 or more.  Null text and text without words have the
    empty set, are linked with nothing and stay.  Rows that repeat a doc_id are
    one node of the graph, with the links of all their texts.  A row without a
    doc_id is a node as well, and takes the component_id of those it is linked
    with; if none of these has an id, its component_id is null and it is kept.
    An empty table gives an empty result.
    """
    return _graph(spark, docs).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: of the rows
    with the component's smallest doc_id (null last) the one with the smallest
    hash of its text.  Rows without words all stay."""
    found = stage(spark, _graph(spark, docs).where("label is not null"), "op8-found")
    stays = (found.groupBy("label")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("stays"))
             .select("label", "stays.doc_id", "stays.key"))
    pairs = found.groupBy("doc_id", "key", "label").agg(F.count(F.lit(1)).alias("n"))
    judged = stage(spark, pairs.join(stays.withColumnsRenamed({"doc_id": "id", "key": "of"}), "label")
                   .select("doc_id", "key", "n", (F.col("doc_id").eqNullSafe(F.col("id"))
                                                  & (F.col("key") == F.col("of"))).alias("stays")), "op8-judged")
    return without_rows(docs, F.xxhash64(F.col("text").cast("string")), judged.where("not stays"),
                        stage(spark, judged.where("stays and n > 1"), "op8-repeated"))
