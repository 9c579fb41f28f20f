"""Order-preserving packing of documents into fixed token windows.

The documents of a stream, one after the other, are cut into windows of at most
``seq_len`` tokens.  Cuts are free between documents, cost a little between
sentences and more inside a sentence; the cuts of least total padding and
penalties are found by dynamic programming over the boundaries,

    best[j] = min over i with pos[j] - pos[i] <= seq_len of
              best[i] + seq_len - (pos[j] - pos[i]) + penalty[j],

where best[i] + pos[i] is the only part that depends on i: a monotone queue
gives its minimum over the sliding range of i in constant time.

A stream is one input partition, read once, in order, without a shuffle.  It is
solved in blocks of a bounded number of tokens; what a block leaves open begins
the next.  The last window of a stream may also be cut into powers of two,
which need no padding.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import slices
from strata.llm.tokens import encoder, public_ranks

SEQ_LEN = 2048
END = 1
BLOCK = 1 << 20
SLICE = 4 << 20
SENTENCE, INSIDE = 16, 256      # penalties, in tokens of padding
STREAM_BITS = 32

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType())])


def cuts(pos: list[int], penalty: list[int], seq_len: int, last: bool) -> list[int]:
    """The chosen positions.  ``pos`` are the boundaries, ascending from 0, no
    further apart than ``seq_len``, with the penalty for a cut at each.  With
    ``last`` the final position is one of the cuts; otherwise the cuts end
    within a window of it."""
    m = len(pos)
    best, back = [0] * m, [0] * m
    queue = deque([0])  # indexes, best[i] + pos[i] ascending
    for j in range(1, m):
        low = pos[j] - seq_len
        while pos[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        back[j] = i
        value = best[j] = best[i] + pos[i] + seq_len - pos[j] + penalty[j]
        value += pos[j]
        while queue and best[queue[-1]] + pos[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    if not last:
        j = min((j for j in range(m) if pos[j] >= pos[-1] - seq_len), key=lambda j: (best[j], -pos[j]))
        return _walk(pos, back, j)
    end = pos[-1]

    def tail(i: int) -> int:
        n = end - pos[i]
        return best[i] + min(seq_len - n, SENTENCE * (n.bit_count() - 1))

    if m == 1:
        return [0]
    i = min((i for i in range(m - 1) if pos[i] >= end - seq_len), key=lambda i: (tail(i), -pos[i]))
    found = _walk(pos, back, i)
    n = end - pos[i]
    if SENTENCE * (n.bit_count() - 1) < seq_len - n:
        for k in reversed(range(n.bit_length())):
            if n >> k & 1:
                found.append(found[-1] + (1 << k))
    else:
        found.append(end)
    return found


def _walk(pos: list[int], back: list[int], j: int) -> list[int]:
    found = [pos[j]]
    while j:
        j = back[j]
        found.append(pos[j])
    return found[::-1]


def boundaries(ids: np.ndarray, ends: np.ndarray, stops: np.ndarray, white: np.ndarray,
               seq_len: int) -> tuple[list[int], list[int]]:
    """Positions at which ``ids`` may be cut, and the penalty of each: the ends
    of documents, of sentences, and, where these are too far apart, places in
    between."""
    cost = np.full(len(ids) + 1, -1, np.int64)
    cost[1:-1][stops[ids[:-1]] & white[ids[1:]]] = SENTENCE
    cost[0] = 0
    cost[ends] = 0
    if cost[-1] < 0:
        cost[-1] = INSIDE
    pos = np.flatnonzero(cost >= 0)
    step = max(1, seq_len // 32)
    far = np.flatnonzero(np.diff(pos) > seq_len // 2)
    if len(far):
        more = np.concatenate([np.arange(pos[i] + step, pos[i + 1], step) for i in far])
        cost[more] = INSIDE
        pos = np.flatnonzero(cost >= 0)
    return pos.tolist(), cost[pos].tolist()


class _Stream:
    """Documents not yet in a sequence, and the number of sequences so far."""

    def __init__(self, ranks_path: str, seq_len: int, end: int, with_ids: bool):
        self.enc, self.seq_len, self.end, self.with_ids = encoder(ranks_path), seq_len, end, with_ids
        self.docs: list = []     # (doc_id, ids, already packed, ids of the whole document)
        self.held = 0
        self.n = TaskContext.get().partitionId() << STREAM_BITS if TaskContext.get() else 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)

    def packed(self, last: bool) -> pa.RecordBatch:
        """The pieces of the sequences that can be closed."""
        out: list = [[] for _ in range(7 + self.with_ids)]
        ids = np.concatenate([d[1] for d in self.docs])
        ends = np.cumsum([len(d[1]) for d in self.docs])
        pos, cost = boundaries(ids, ends, self.enc.stops, self.enc.white, self.seq_len)
        seq = np.array(cuts(pos, cost, self.seq_len, last))
        starts = np.concatenate([[0], ends[:-1]])
        edge = np.unique(np.concatenate([seq, starts[starts < seq[-1]]]))
        which = np.searchsorted(ends, edge[:-1], side="right")
        inside = np.searchsorted(seq, edge[:-1], side="right") - 1
        for a, b, d, s in zip(edge[:-1].tolist(), edge[1:].tolist(), which.tolist(), inside.tolist(),
                              strict=True):
            doc_id, _, done, total = self.docs[d]
            raw = ids[a:b].astype("<u4").tobytes()
            row = (doc_id, done + a - int(starts[d]), b - a, zlib.crc32(raw), total, self.n + s,
                   a - int(seq[s]))
            for column, value in zip(out, (*row, raw) if self.with_ids else row, strict=True):
                column.append(value)
        self.n += len(seq) - 1
        rest = []
        for (doc_id, own, done, total), start, stop in zip(self.docs, starts.tolist(), ends.tolist(),
                                                           strict=True):
            if stop > seq[-1]:
                gone = max(0, int(seq[-1]) - start)
                rest.append((doc_id, own[gone:], done + gone, total))
        self.docs, self.held = rest, len(ids) - int(seq[-1])
        arrays = [pa.array(c, pa.int64()) for c in out[:7]]
        if self.with_ids:
            arrays.append(pa.array(out[7], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, [f.name for f in PIECES] + ["ids"] * self.with_ids)


def _packer(ranks_path: str, seq_len: int, end: int, with_ids: bool, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = None
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                stream = stream or _Stream(ranks_path, seq_len, end, with_ids)
                ids, at = stream.enc.ids(part.column("text"), end)
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), at[:-1], at[1:], strict=True):
                    stream.add(doc_id, ids[a:b])
                    if stream.held >= block:
                        yield stream.packed(last=False)
        if stream and stream.docs:
            yield stream.packed(last=True)
    return run


def pack(docs: DataFrame, ranks_path: str | None = None, seq_len: int = SEQ_LEN, end: int = END,
         with_ids: bool = False, block: int = BLOCK) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, start (ids of its document
    before it), length, ids_crc32, doc_tokens, sequence_id, offset (in the
    sequence), and with ``with_ids`` the ids as little-endian 32-bit integers.

    Every document is its ids and then ``end``; null and empty text is ``end``
    alone.  Each id lies in one piece, the pieces of a sequence follow each
    other without gaps in the order of the input, and a sequence has at most
    ``seq_len`` ids.  Rows that repeat a doc_id, or have none, are packed each
    for itself.  The ids of sequences are unique, not gapless.  An empty table
    gives an empty result.
    """
    schema = T.StructType(PIECES.fields + [T.StructField("ids", T.BinaryType())] * with_ids)
    return (docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
            .mapInArrow(_packer(ranks_path or public_ranks(), seq_len, end, with_ids, block), schema))
