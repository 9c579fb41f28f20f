"""Training-order materialisation: token sequences at permuted global slots.

The ids of the documents of an input partition, one document after the other,
are cut into sequences of ``seq_len``.  With the number of sequences of every
partition known, sequence number i of all N goes to slot P(i), P a keyed
Feistel permutation of 0 .. N-1 (cycle-walking keeps it in that range): a
shuffled training order without a random column and without a global sort.

The slots are dealt in ranges, a shard a range, and written as binary records
of one fixed size.  So slot s is record s % shard_len of shard s // shard_len,
at a known byte, and a reader can start or resume at any slot.

Record (little-endian): doc_id and place in that document of the first token
(two 64-bit integers), number of tokens, 1 if that doc_id is null (32 bits
each), seq_len ids of 16 bits, 8 zero bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import slices
from strata.llm.feistel import permuted
from strata.llm.tokens import encoder, public_ranks
from strata.session import scratch_path

SEQ_LEN = 1024
SHARD_LEN = 1 << 13
END = 50256
SLICE = 12 << 20
TRAILER = 8


def record_type(seq_len: int) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("start", "<i8"), ("n", "<i4"), ("null", "<i4"),
                     ("ids", "<u2", (seq_len,)), ("zero", f"V{TRAILER}")])


@dataclass(frozen=True)
class Shards:
    """Where the records are, and how to find a slot."""
    path: str
    n: int
    seq_len: int
    shard_len: int

    @property
    def stride(self) -> int:
        return record_type(self.seq_len).itemsize

    def place(self, slot: int) -> tuple[int, int]:
        """Shard and first byte of a slot."""
        return slot // self.shard_len, slot % self.shard_len * self.stride


def _counted(ranks_path: str, seq_len: int):
    """Number of sequences of each input partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                total += int(encoder(ranks_path).lengths(part.column("text")).sum()) + part.num_rows
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()),
                 pa.array([-(-total // seq_len)], pa.int64())], ["stream", "n"])
    return run


def _records(ranks_path: str, seq_len: int, shard_len: int, end: int, key: str, total: int, first):
    """Shard, slot and record of every sequence of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = TaskContext.get().partitionId()
        base, expected = first.value.get(stream, (0, 0))
        ids = np.empty(0, np.uint32)        # not yet in a sequence
        owner: list = []                    # (doc_id, place of its first held id, ids held)
        done = 0

        def closed(n: int, held: np.ndarray) -> pa.RecordBatch:
            nonlocal owner, done
            out = np.zeros(n, record_type(seq_len))
            out["n"] = np.minimum(seq_len, len(held) - np.arange(n) * seq_len)
            padded = np.zeros(n * seq_len, np.uint16)
            padded[:len(held)] = held
            out["ids"] = padded.reshape(n, seq_len)
            ends = np.cumsum([o[2] for o in owner])
            which = np.searchsorted(ends, np.arange(n) * seq_len, side="right")
            for i, w in enumerate(which.tolist()):
                doc_id, start, size = owner[w]
                out[i]["doc_id"], out[i]["null"] = (0, 1) if doc_id is None else (doc_id, 0)
                out[i]["start"] = start + i * seq_len - (ends[w] - size)
            used = len(held)
            keep = np.searchsorted(ends, used, side="right")
            left = []
            for k, (doc_id, start, size) in enumerate(owner[keep:], keep):
                gone = max(0, used - int(ends[k] - size))
                left.append((doc_id, start + gone, size - gone))
            owner = left
            slot = permuted(base + done + np.arange(n), total, key)
            done += n
            return pa.RecordBatch.from_arrays(
                [pa.array(slot // shard_len, pa.int32()), pa.array(slot, pa.int64()),
                 pa.array([r.tobytes() for r in out], pa.binary())], ["shard", "slot", "record"])

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                new, at = encoder(ranks_path).ids(part.column("text"), end)
                owner += zip(part.column("doc_id").to_pylist(), [0] * part.num_rows,
                             np.diff(at).tolist(), strict=True)
                ids = np.concatenate([ids, new])
                n = len(ids) // seq_len
                if n:
                    yield closed(n, ids[:n * seq_len])
                    ids = ids[n * seq_len:]
        if len(ids):
            yield closed(1, ids)
        if done != expected:
            raise RuntimeError(f"partition {stream} has {done} sequences, {expected} were counted: "
                               "its rows are not the same at each reading")
    return run


def materialise(spark: SparkSession, docs: DataFrame, key: str = "order-0",
                ranks_path: str | None = None, seq_len: int = SEQ_LEN, shard_len: int = SHARD_LEN,
                end: int = END) -> Shards:
    """Write the sequences of ``docs`` (doc_id, text) as shards in the shared
    folder.  ``docs`` must come from files, so that both readings have the same
    partitions (the second checks it).

    Null and empty text is ``end`` alone.  The last sequence of a partition may
    be shorter; its record is filled with zeros.  Rows that repeat a doc_id, or
    have none, are sequences like others.  An empty table writes no record.
    """
    ranks_path = ranks_path or public_ranks()
    own = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    counts = sorted(own.mapInArrow(_counted(ranks_path, seq_len), "stream bigint, n bigint")
                    .collect())  # a row per task
    first, total = {}, 0
    for stream, n in counts:
        first[stream] = (total, n)
        total += n
    path = scratch_path(spark, "op3-shards")
    sent = spark.sparkContext.broadcast(first)
    # Ranges of shards by number, which takes no sample of the sequences first.
    n_shards = max(1, -(-total // shard_len))
    ranges = min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (own.mapInArrow(_records(ranks_path, seq_len, shard_len, end, key, total, sent),
                    "shard int, slot bigint, record binary")
     .repartitionById(ranges, F.expr(f"cast(div(cast(shard as bigint) * {ranges}, {n_shards}) as int)"))
     .sortWithinPartitions("shard", "slot")
     # bytes as they are; the writer adds the zeros that end a record
     .select("shard", F.col("record").substr(F.lit(1), F.octet_length("record") - TRAILER)
             .cast("string").alias("value"))
     .write.option("lineSep", "\0" * TRAILER).partitionBy("shard").text(path))
    return Shards(path, total, seq_len, shard_len)


def _read(shard_len: int, seq_len: int, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = np.frombuffer(batch.column("content")[i].as_buffer(), record_type(seq_len))
                shard = batch.column("shard")[i].as_py()
                slot = shard * shard_len + np.arange(len(rows), dtype=np.int64)
                rows, slot = rows[slot >= first], slot[slot >= first]
                n = rows["n"].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(np.full(len(rows), shard, np.int32)),
                     pa.array((slot % shard_len) * record_type(seq_len).itemsize),
                     pa.array(rows["doc_id"].copy(), mask=rows["null"] == 1),
                     pa.array(rows["start"].copy()), pa.array(n),
                     pa.array([r[:k].tobytes() for r, k in zip(rows["ids"], n, strict=True)],
                              pa.binary())], [f.name for f in SEQUENCES])
    return run


SEQUENCES = T.StructType([
    T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType()),
    T.StructField("byte", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("n_tokens", T.IntegerType()),
    T.StructField("ids", T.BinaryType())])


def read(spark: SparkSession, shards: Shards, first: int = 0) -> DataFrame:
    """The sequences from slot ``first`` on, read from the shards: slot, shard,
    byte (of its record), doc_id and start of the first token, n_tokens, ids
    (little-endian 16-bit).  Earlier shards are not opened."""
    if not shards.n:
        return spark.createDataFrame([], SEQUENCES)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(shards.path)
             .where(F.col("shard") >= first // shards.shard_len))
    return files.select("shard", "content").mapInArrow(
        _read(shards.shard_len, shards.seq_len, first), SEQUENCES)
