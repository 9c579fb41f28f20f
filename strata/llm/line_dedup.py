"""Line deduplication with two Bloom filters.

The first pass hashes every long line and keeps two filters: hashes seen once,
and hashes seen (at least) twice, a line counting once per document.  Each task
sends the set positions of its filters, cut into segments; a segment's owner
merges them (a position set by two tasks has been seen twice).  The second pass
tests every line against the twice-seen filter, and only the lines it suspects
are shuffled, with their whole keys, for exact confirmation and the choice of
the document that keeps the line.

The filters have false positives, never false negatives, so the result is exact
whatever their size; a small filter only makes more lines travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import U64, mixed, slices, stage

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_LINE = 16
SEGMENT_LOG2 = 19        # bits of a segment: 64 KB when packed
MAX_LOG2 = 29            # 64 MB: the most that is sent to the executors
STRIPPED = b" \t\n\x0b\x0c\r"
SLICE = 8 << 20


def _key(line: bytes, min_chars: int) -> bytes | None:
    """The line's key, or None where it is too short to count."""
    key = line.strip(STRIPPED).lower()  # bytes: only A-Z are lower-cased
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


def _positions(h: np.ndarray, log2: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment and the two bits in it, for each hash."""
    segment = (h >> U64(64 - (log2 - SEGMENT_LOG2))).astype(np.int64) if log2 > SEGMENT_LOG2 \
        else np.zeros(len(h), np.int64)
    mask = U64((1 << SEGMENT_LOG2) - 1)
    return segment, (h & mask).astype(np.int64), (mixed(h) & mask).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _sighted(min_chars: int, log2: int):
    """Per task and segment, the bits of the lines seen once and seen twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for text in _texts(part):
                    keys = {k for k in (_key(x, min_chars) for x in text.split(b"\n")) if k}
                    if keys:
                        seen.append(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), U64, len(keys)))
        if not seen:
            return
        h, n = np.unique(np.concatenate(seen), return_counts=True)
        segment, a, b = _positions(h, log2)
        order = np.argsort(segment, kind="stable")
        segment, a, b, twice = segment[order], a[order], b[order], (n > 1)[order]
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        for lo, hi in zip(starts, [*starts[1:], len(segment)], strict=True):
            pair = np.concatenate([a[lo:hi], b[lo:hi]]).astype("<u4")
            both = np.concatenate([twice[lo:hi], twice[lo:hi]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment[lo]], pa.int32()), pa.array([pair.tobytes()], pa.binary()),
                 pa.array([pair[both].tobytes()], pa.binary())], ["segment", "once", "twice"])
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The twice-seen filter of each segment; rows come sorted by segment."""
    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())],
            ["segment", "bits"])

    at = once = twice = None
    for batch in batches:
        for segment, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if segment != at:
                if at is not None:
                    yield flush()
                at = segment
                once, twice = np.zeros(1 << SEGMENT_LOG2, bool), np.zeros(1 << SEGMENT_LOG2, bool)
            bits = np.frombuffer(x, "<u4")
            twice[bits[once[bits]]] = True
            once[bits] = True
            twice[np.frombuffer(y, "<u4")] = True
    if at is not None:
        yield flush()


def twice_seen(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS,
               max_log2: int = MAX_LOG2) -> tuple[np.ndarray, int]:
    """The packed filter of the lines seen in two documents or more, and the
    log2 of its bits, which follows the number of lines up to ``max_log2``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
                     ).first()[0] or 0
    log2 = max(SEGMENT_LOG2, min(max_log2, (lines * BITS_PER_LINE).bit_length()))
    found = (docs.select("text")
             .mapInArrow(_sighted(min_chars, log2), "segment int, once binary, twice binary")
             .repartition("segment").sortWithinPartitions("segment")
             .mapInArrow(_merged, "segment int, bits binary"))
    packed = np.zeros(1 << (log2 - 3), np.uint8)
    size = 1 << (SEGMENT_LOG2 - 3)
    for row in found.toLocalIterator(prefetchPartitions=True):
        packed[row["segment"] * size:(row["segment"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return packed, log2


def _suspected(min_chars: int, log2: int, filter_bits):
    """doc_id, tie and key of the lines that the twice-seen filter holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = filter_bits.value

        def held(segment, bit):
            at = (segment << SEGMENT_LOG2) + bit
            return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                rows, keys = [], []
                for i, text in enumerate(_texts(part)):
                    own = {k for k in (_key(x, min_chars) for x in text.split(b"\n")) if k}
                    rows += [i] * len(own)
                    keys += own
                if not keys:
                    continue
                segment, a, b = _positions(
                    np.fromiter(map(xxhash.xxh3_64_intdigest, keys), U64, len(keys)), log2)
                hit = np.flatnonzero(held(segment, a) & held(segment, b))
                at = pa.array(np.asarray(rows, np.int64)[hit])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("tie").take(at),
                     pa.array([keys[i] for i in hit], pa.binary()).cast(pa.string())],
                    ["doc_id", "tie", "key"])
    return run


def _without(min_chars: int):
    """Each document without the lines whose key is in ``gone``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n_lines, n_dropped, kept = [], [], []
                gone_of = part.column("gone").cast(pa.list_(pa.binary())).to_pylist()
                for text, gone in zip(_texts(part), gone_of, strict=True):
                    lines = text.split(b"\n")
                    if gone:
                        gone = set(gone)
                        rest = [x for x in lines if _key(x, min_chars) not in gone]
                    else:
                        rest = lines
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(rest))
                    kept.append(b"\n".join(rest))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_lines, pa.int64()),
                     pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_lines", "n_dropped", "kept_text"])
    return run


def line_dedup(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS,
               min_docs: int = MIN_DOCS, max_log2: int = MAX_LOG2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_lines, n_dropped, kept_text.

    A line's key is the line without white space at its ends, A-Z lower-cased.
    Lines whose key has ``min_chars`` code points and is found in ``min_docs``
    documents (distinct doc_ids) go, except in the document with the largest
    doc_id that holds it; there every occurrence stays.  Null text counts as
    one empty line.  Rows that repeat a doc_id count as one document and lose
    the same lines.  A null doc_id counts as no document: such rows lose the
    lines that enough others hold.  An empty table gives an empty result.
    """
    doc_type = docs.schema["doc_id"]
    own = docs.select("doc_id", "text", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
                      .otherwise(F.lit(0)).cast("bigint").alias("tie"))
    packed, log2 = twice_seen(spark, own, min_chars, max_log2)
    sent = spark.sparkContext.broadcast(packed)
    tie = T.StructField("tie", T.LongType())
    suspects = stage(spark, own.mapInArrow(
        _suspected(min_chars, log2, sent),
        T.StructType([doc_type, tie, T.StructField("key", T.StringType())])), "op4-suspects")
    # Written first: the join then has an exchange of its own on either side, of which a hot key's can be split.
    repeated = stage(spark, suspects.groupBy("key")
                     .agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("last"))
                     .where(F.col("n") >= min_docs).select("key", "last"), "op4-repeated")
    gone = (suspects.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("last")))
            .groupBy(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"))
            .agg(F.collect_set("key").alias("gone")))
    return (own.join(gone, F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("tie") == F.col("_tie")), "left")
            .select("doc_id", "text", "gone")
            .mapInArrow(_without(min_chars), T.StructType([
                doc_type, T.StructField("n_lines", T.LongType()),
                T.StructField("n_dropped", T.LongType()),
                T.StructField("kept_text", T.StringType())])))


ORACLE = r"""
with doc as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
line as (
    select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as idx from doc),
keyed as (
    select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from line),
repeated as (
    select key, max(doc_id) as last_id from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3),
marked as (
    select k.doc_id, k.line, k.idx, r.key is not null and k.doc_id <> r.last_id as gone
    from keyed k left join repeated r on k.key = r.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by idx) filter (where not gone), ''))
           as kept_sha256
from marked group by doc_id
"""
