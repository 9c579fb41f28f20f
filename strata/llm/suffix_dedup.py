"""Repeated passages by bucket-pointer refinement of suffixes.

A byte goes if a string of 50 bytes that covers it also starts in a document
with a smaller doc_id.  Suffixes are put into buckets by an initial gram and
the buckets are refined, by sorting on the bucket pointers of later offsets,
until 50 bytes are told apart; the pointers that a pass has refined are the ones
the next pass sorts on, and buckets of one suffix are settled and left alone.

Only what may repeat is refined.  Each string of 50 bytes has an *anchor*, its
20-gram of smallest hash, so equal strings have equal anchors, and consecutive
strings with the same anchor are one *piece* of text.

1. Documents become slices, a compressed row each, that all later steps refer to.
2. Owners of ranges of the anchors' hashes get each slice's distinct ones and
   answer with a bit per hash: whether another text has it too.
3. The pieces of anchors that others have go to the anchors' owners, where
   their suffixes are refined; a piece's document learns which of its strings
   are the first, and drops the others.

Equal pieces of a slice travel once, equal texts are one class whose smallest
doc_id stands for all, and an anchor that very many slices share is split by
whole strings, so no common passage gathers in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import U64, remove, slices, stage, staged_inside

SPAN = 50                # bytes of a string
GRAM = 20                # bytes of an anchor
WIDTH = SPAN - GRAM + 1  # grams, and at most as many strings of a piece
FIRST = 8                # bytes of the initial buckets
SLICE = 4 << 20
WINDOWS = 1 << 16        # strings whose anchors are found at once
OWNER_BYTES = 64 << 20   # of text to an owner
HOT_SLICES = 1 << 12     # an anchor in more slices is split by strings
PIECES = 1 << 14         # pieces refined at once
LAST = np.iinfo(np.int64).max

_BASE = [U64(0x9E3779B97F4A7C15)]
with np.errstate(over="ignore"):
    for _ in range(4):
        _BASE.append(_BASE[-1] * _BASE[-1])
_LOW = U64(0xFFFFFFFF)


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the 20 bytes from each position on."""
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        of = {1: data.astype(U64) + U64(1)}
        for k in range(4):       # of twice as many bytes each time
            own, size = of[1 << k], 1 << k
            of[2 * size] = own[:-size] * _BASE[k] + own[size:]
        h = of[16][:n] * _BASE[2] + of[4][16:16 + n]
        h ^= h >> U64(32)
        h *= U64(0xD6E8FEB86659FD93)
        h ^= h >> U64(29)
        h *= U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def pieces(data: np.ndarray, ends: np.ndarray, windows: int = WINDOWS
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of the texts that lie one after another in ``data``: text,
    first place, number of strings, and the hash of the anchor."""
    out: list[tuple[np.ndarray, ...]] = []
    begins = np.append(0, ends[:-1])
    for lo in range(0, len(data) - SPAN + 1, windows):
        part = data[lo:lo + windows + SPAN - 1]
        n = len(part) - SPAN + 1
        h = _grams(part)
        low, size = h, 1
        while size < WIDTH:
            step = min(size, WIDTH - size)
            low = np.minimum(low[:-step], low[step:])
            size += step
        new = np.ones(n, bool)
        new[1:] = (low[1:] != low[:-1]) | (h[:n - 1] == low[:-1])
        for at in (begins, ends - SPAN + 1):
            at = at[(at >= lo) & (at < lo + n)] - lo
            new[at] = True
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, n))
        text = np.searchsorted(ends, at + lo, side="right")
        inside = at + lo + SPAN <= ends[np.minimum(text, len(ends) - 1)]
        at, count, text = at[inside], count[inside], text[inside]
        anchor = h[at[:, None] + np.arange(WIDTH)].argmin(axis=1) + at
        out.append((text, at + lo, count, h[anchor]))
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, U64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


# Slices ------------------------------------------------------------------

_SLICE = pa.schema([("ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary())),
                    ("lengths", pa.list_(pa.int64())), ("texts", pa.binary())])
_SLICE_SQL = "ids array<bigint>, digests array<binary>, lengths array<bigint>, texts binary"


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            texts = [t.as_buffer() for t in pc.fill_null(part.column("text"), "")]
            joined = b"".join(texts)
            yield pa.RecordBatch.from_pylist([{
                "ids": part.column("doc_id").to_pylist(),
                "digests": [xxhash.xxh3_128_digest(t) for t in texts],
                "lengths": [len(t) for t in texts],
                "texts": pa.compress(joined, "zstd", asbytes=True)}], _SLICE)


class _Slice:
    """A slice as its tasks see it."""

    def __init__(self, row: dict, owners: int):
        self.lengths = np.array(row["lengths"], np.int64)
        self.ends = np.cumsum(self.lengths)
        size = int(self.ends[-1]) if len(self.ends) else 0
        self.data = np.frombuffer(pa.decompress(row["texts"], size, "zstd"), np.uint8) if size \
            else np.empty(0, np.uint8)
        self.ids = row["ids"]
        self.rank = np.array([LAST if i is None else i for i in row["ids"]], np.int64)
        self.owners = owners
        self.text, self.at, self.count, key = pieces(self.data, self.ends)
        self.code = (key >> U64(32)) % U64(owners) << U64(32) | key & _LOW

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct codes of the pieces, and the number of each piece's."""
        code, number = np.unique(self.code, return_inverse=True)
        return code, number.reshape(-1)

    def take(self, which: np.ndarray) -> None:
        self.text, self.at, self.count, self.code = (
            x[which] for x in (self.text, self.at, self.count, self.code))

    def split(self, hot: np.ndarray) -> None:
        """The pieces that ``hot`` says as pieces of one string each, by the hash of the string."""
        if not hot.any():
            return
        one = np.repeat(np.flatnonzero(hot), self.count[hot])
        number = np.arange(len(one)) - np.repeat(np.cumsum(self.count[hot]) - self.count[hot], self.count[hot])
        at = self.at[one] + number
        key = np.array([xxhash.xxh3_64_intdigest(self.data[a:a + SPAN]) for a in at.tolist()], U64)
        code = (key >> U64(32)) % U64(self.owners) << U64(32) | key & _LOW
        self.text = np.append(self.text[~hot], self.text[one])
        self.code = np.append(self.code[~hot], code)
        self.at = np.append(self.at[~hot], at)
        self.count = np.append(self.count[~hot], np.ones(len(at), np.int64))

    def answered(self, answers: list[dict], low: list[int]) -> None:
        """Keep the pieces of anchors that other texts have, of texts that stand
        for their class, whose smallest rank is ``low``."""
        code, number = self.distinct()
        shared, hot = np.zeros(len(code), bool), np.zeros(len(code), bool)
        for a in answers:
            lo, hi = np.searchsorted(code, np.array([a["owner"] << 32, (a["owner"] + 1) << 32], U64))
            for name, of in (("shared", shared), ("hot", hot)):
                of[lo:hi] = np.unpackbits(np.frombuffer(a[name], np.uint8), count=hi - lo)
        own = shared[number] & (self.rank == np.array(low, np.int64))[self.text]
        hot = hot[number][own]
        self.take(own)
        self.split(hot)

    def bytes_of(self) -> Iterator[bytes]:
        raw = self.data.tobytes()
        for a, n in zip(self.at.tolist(), self.count.tolist(), strict=True):
            yield raw[a:a + n + SPAN - 1]


# Anchors and their owners --------------------------------------------------

def _anchors(owners: int):
    """A row per slice and owner: the owner's codes of the slice, and which of
    them two texts of the slice have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _Slice(row, owners)
                first = {d: t for t, d in reversed(list(enumerate(row["digests"])))}
                stands = np.array([first[d] == t for t, d in enumerate(row["digests"])], bool)
                code, number = own.distinct()
                if not len(code):
                    continue
                of = stands[own.text]
                seen = np.sort(number[of] * len(stands) + own.text[of])
                seen = seen[np.append(True, seen[1:] != seen[:-1])] if len(seen) else seen
                many = np.bincount(seen // len(stands), minlength=len(code)) > 1
                owner = (code >> U64(32)).astype(np.int64)
                cut = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                for lo, hi in zip(cut, np.append(cut[1:], len(code)), strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(owner[lo])], pa.int32()), pa.array([row["slice"]], pa.int64()),
                         pa.array([(code[lo:hi] & _LOW).astype(np.uint32).tobytes()], pa.binary()),
                         pa.array([np.packbits(many[lo:hi]).tobytes()], pa.binary())],
                        ["owner", "slice", "codes", "many"])
    return run


def _shared(hot_slices: int):
    """An owner's answer to each slice: which of its codes other texts have, and
    which are in very many slices.  An owner is a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, slice_, codes, many = [], [], [], []
        for batch in batches:
            owner += batch.column("owner").to_pylist()
            slice_ += batch.column("slice").to_pylist()
            own = [np.frombuffer(c.as_buffer(), np.uint32) for c in batch.column("codes")]
            codes += own
            many += [np.unpackbits(np.frombuffer(m.as_buffer(), np.uint8), count=len(c)).astype(bool)
                     for m, c in zip(batch.column("many"), own, strict=True)]
        if not owner:
            return
        flat = np.concatenate(codes).astype(np.int64) | np.repeat(owner, [len(c) for c in codes]) << 32
        order = np.argsort(flat)
        head = np.append(True, flat[order][1:] != flat[order][:-1])
        group = np.cumsum(head) - 1
        n = np.bincount(group)[group]
        shared, hot = np.empty(len(flat), bool), np.empty(len(flat), bool)
        shared[order], hot[order] = n > 1, n > hot_slices
        shared |= np.concatenate(many)
        cut = np.cumsum([len(c) for c in codes])[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner, pa.int32()), pa.array(slice_, pa.int64()),
             pa.array([np.packbits(x).tobytes() for x in np.split(shared, cut)], pa.binary()),
             pa.array([np.packbits(x).tobytes() for x in np.split(hot, cut)], pa.binary())],
            ["owner", "slice", "shared", "hot"])
    return run


# Pieces and their refinement ----------------------------------------------

_PIECES = "owner int, slice bigint, codes binary, sizes binary, bytes binary, ranks binary, texts binary, places binary"


def _sent(owners: int):
    """A row per slice and owner: the slice's distinct pieces of the owner's
    anchors, each for the text of smallest rank that has it (all, if several)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _Slice(row, owners)
                own.answered(row["answers"] or [], row["low"])
                best: dict[bytes, list[int]] = {}
                rank, text = own.rank[own.text].tolist(), own.text.tolist()
                for k, span in enumerate(own.bytes_of()):
                    held = best.get(span)
                    if held is None or rank[k] < rank[held[0]]:
                        best[span] = [k]
                    elif rank[k] == rank[held[0]] and text[k] != text[held[-1]]:
                        held.append(k)
                spans = [s for s, held in best.items() for _ in held]
                which = np.array([k for held in best.values() for k in held], np.int64)
                order = np.argsort(own.code[which], kind="stable")
                which, code = which[order], own.code[which][order]
                owner = (code >> U64(32)).astype(np.int64)
                cut = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else []
                for lo, hi in zip(cut, np.append(cut[1:], len(owner)), strict=True):
                    part = which[lo:hi]
                    joined = b"".join(spans[k] for k in order[lo:hi].tolist())
                    columns = [(code[lo:hi] & _LOW).astype(np.uint32), (own.count[part] + SPAN - 1).astype(np.uint8),
                               joined, own.rank[own.text[part]], own.text[part].astype(np.int32),
                               (own.at[part] - (own.ends - own.lengths)[own.text[part]])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(owner[lo])], pa.int32()), pa.array([row["slice"]], pa.int64()),
                         *(pa.array([_squeezed(c)], pa.binary()) for c in columns)],
                        [c.split()[0] for c in _PIECES.split(", ")])
    return run


def _squeezed(values) -> bytes:
    raw = values if isinstance(values, bytes) else values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _full(squeezed: bytes) -> bytes:
    return pa.decompress(squeezed[8:], int.from_bytes(squeezed[:8], "little"), "zstd", asbytes=True)


def refined(data: np.ndarray, room: np.ndarray, depth: int = SPAN) -> np.ndarray:
    """Bucket pointers of the suffixes of ``data``, of which ``room`` bytes
    belong to the suffix: equal for those with ``room`` of at least ``depth``
    whose first ``depth`` bytes are equal, different if these differ.

    A pointer is the place of its bucket's first suffix in the sorted order."""
    n = len(data)
    wide = np.zeros(n, U64)
    padded = np.append(data, np.zeros(FIRST, np.uint8))
    for k in range(FIRST):
        wide = wide << U64(8) | padded[k:k + n].astype(U64)
    order = np.argsort(wide)
    head = np.append(True, wide[order][1:] != wide[order][:-1])
    pointer = np.empty(n, np.int64)
    pointer[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    known = FIRST
    while known < depth:
        step = min(known, depth - known)
        size = np.bincount(pointer, minlength=n)
        live = np.flatnonzero((room >= known + step) & (size[pointer] > 1))
        if not len(live):
            break
        key = pointer[live] << 32 | pointer[live + step]
        order = np.argsort(key)
        key, live = key[order], live[order]
        bucket = np.append(True, key[1:] >> 32 != key[:-1] >> 32)
        part = np.append(True, key[1:] != key[:-1])
        place = np.arange(len(live))
        pointer[live] = (key >> 32) + (np.maximum.accumulate(np.where(part, place, 0))
                                       - np.maximum.accumulate(np.where(bucket, place, 0)))
        known += step
    return pointer


def first_strings(spans: list[bytes], rank: np.ndarray) -> np.ndarray:
    """For each piece the strings that no piece of smaller rank has, as bits."""
    size = np.array([len(s) for s in spans], np.int64)
    data = np.frombuffer(b"".join(spans), np.uint8)
    end = np.cumsum(size)
    room = np.repeat(end, size) - np.arange(len(data))
    pointer = refined(data, room)
    string = np.flatnonzero(room >= SPAN)
    piece = np.repeat(np.arange(len(spans)), size - SPAN + 1)
    order = np.argsort(pointer[string])
    sorted_ = pointer[string][order]
    head = np.append(True, sorted_[1:] != sorted_[:-1])
    least = np.minimum.reduceat(rank[piece][order], np.flatnonzero(head))
    first = np.empty(len(string), bool)
    first[order] = least[np.cumsum(head) - 1] >= rank[piece][order]
    number = string - (end - size)[piece]
    bits = np.where(first, np.int64(1) << number, 0)
    return np.add.reduceat(bits, np.cumsum(size - SPAN + 1) - (size - SPAN + 1))


def _refinement(most: int):
    """An owner's pieces, refined, and for each slice those with first strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}    # of the distinct pieces
        codes: list[int] = []
        least: list[int] = []
        who: list = []                   # slice, text and place of those with the least rank
        for batch in batches:
            for row in batch.to_pylist():
                code, size, rank, text, place = (
                    np.frombuffer(_full(row[c]), of).tolist() for c, of in
                    (("codes", np.uint32), ("sizes", np.uint8), ("ranks", np.int64), ("texts", np.int32),
                     ("places", np.int64)))
                raw, at, slice_ = _full(row["bytes"]), 0, row["slice"]
                for k, n in enumerate(size):
                    span = raw[at:at + n]
                    at += n
                    j = number.setdefault(span, len(codes))
                    if j == len(codes):
                        codes.append(code[k])
                        least.append(rank[k])
                        who.append((slice_, text[k], place[k]))
                    elif rank[k] < least[j]:
                        least[j], who[j] = rank[k], (slice_, text[k], place[k])
                    elif rank[k] == least[j]:
                        who[j] = (*who[j], slice_, text[k], place[k])
        spans, order = list(number), np.argsort(np.array(codes, np.int64))
        sorted_ = np.array(codes, np.int64)[order]
        answers: dict[int, list[tuple[int, int, int]]] = {}
        lo = 0
        while lo < len(order):
            # An anchor's pieces stay together.
            hi = int(np.searchsorted(sorted_, sorted_[min(lo + most, len(order)) - 1], side="right"))
            part = order[lo:hi].tolist()
            first = first_strings([spans[j] for j in part], np.array([least[j] for j in part], np.int64))
            for j, bits in zip(part, first.tolist(), strict=True):
                if bits:
                    for k in range(0, len(who[j]), 3):
                        answers.setdefault(who[j][k], []).append((*who[j][k + 1:k + 3], bits))
            lo = hi
        for slice_, rows in answers.items():
            text, place, bits = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([slice_], pa.int64()),
                 *(pa.array([_squeezed(x)], pa.binary()) for x in (text, place, bits))],
                ["slice", "text", "place", "bits"])
    return run


# Results --------------------------------------------------------------------

_RESULT = ("doc_id bigint, n_bytes bigint, n_removed bigint, "
           "spans array<struct<start: bigint, end: bigint>>, kept binary")
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _results(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _slice_result(row, owners)
    return run


def _slice_result(row: dict, owners: int) -> pa.RecordBatch:
    own = _Slice(row, owners)
    own.answered(row["answers"] or [], row["low"])
    begin = own.ends - own.lengths
    raw = own.data.tobytes()
    # Which strings of a text's pieces are first: of those without an answer none.
    first: dict[tuple[int, bytes], int] = {}
    size = {}
    for text, at, count in zip(own.text.tolist(), own.at.tolist(), own.count.tolist(), strict=True):
        size[text, at] = count
    for answer in row["first"] or []:
        columns = (np.frombuffer(_full(answer[c]), np.int64).tolist() for c in ("text", "place", "bits"))
        for text, place, bits in zip(*columns, strict=True):
            at = int(begin[text]) + place
            first[text, raw[at:at + size[text, at] + SPAN - 1]] = bits
    bits = np.array([first.get((t, span), 0) for t, span in zip(own.text.tolist(), own.bytes_of(), strict=True)],
                    np.int64)
    gone = ((~bits[:, None] >> np.arange(WIDTH)) & 1).astype(bool) & (np.arange(WIDTH) < own.count[:, None])
    which, number = np.nonzero(gone)
    order = np.argsort(own.at[which] + number)
    start, text = (own.at[which] + number)[order], own.text[which][order]
    # Strings that overlap or touch are one run; so is a whole text with a copy of smaller id.
    opens = np.ones(len(start), bool)
    opens[1:] = (start[1:] > start[:-1] + SPAN) | (text[1:] != text[:-1])
    last = np.append(opens[1:], True) if len(opens) else opens
    copy = np.flatnonzero((own.rank > np.array(row["low"], np.int64)) & (own.lengths >= SPAN))
    lo = np.concatenate([start[opens], begin[copy]])
    hi = np.concatenate([start[last] + SPAN, own.ends[copy]])
    order = np.argsort(lo)
    lo, hi = lo[order], hi[order]
    text = np.searchsorted(own.ends, lo, side="right")
    change = np.zeros(len(own.data) + 1, np.int8)
    change[lo] += 1
    change[hi] -= 1
    left = own.data[np.cumsum(change[:-1], dtype=np.int8) == 0]
    n_removed = np.bincount(text, hi - lo, len(own.ids)).astype(np.int64)
    kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own.ids), [
        None, pa.py_buffer(np.append(0, np.cumsum(own.lengths - n_removed))), pa.py_buffer(left)])
    bounds = np.searchsorted(text, np.arange(len(own.ids) + 1))
    spans = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(
        [pa.array(lo - begin[text]), pa.array(hi - begin[text])], fields=list(_SPAN)))
    return pa.RecordBatch.from_arrays(
        [pa.array(own.ids, pa.int64()), pa.array(own.lengths), pa.array(n_removed), spans,
         kept.cast(pa.binary())],
        ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def without_repeats(spark: SparkSession, docs: DataFrame, hot_slices: int = HOT_SLICES,
                    pieces_at_once: int = PIECES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, spans
    (the maximal removed runs of bytes: start, and end exclusive) and kept (the
    remaining bytes).

    A byte of the UTF-8 text is removed if a string of 50 bytes that covers it
    also starts in a row with a smaller doc_id; strings are judged on the input.
    Null text counts as empty; texts under 50 bytes stay.  A null doc_id counts
    as larger than all others; rows with the same doc_id, or both without one,
    take nothing from each other.  Each row has its result; an empty table gives
    an empty result.  Other columns are ignored.
    """
    with staged_inside() as made:
        found = _without_repeats(spark, docs, hot_slices, pieces_at_once)
    remove(spark, made, "op13-slices", "op13-told", "op13-first")
    return found


def _without_repeats(spark: SparkSession, docs: DataFrame, hot_slices: int, pieces_at_once: int) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = stage(spark, own.mapInArrow(_sliced, _SLICE_SQL)
                .withColumn("slice", F.monotonically_increasing_id()), "op13-slices")
    length = cut.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), length // OWNER_BYTES + 1)

    # Classes of equal texts, and the smallest rank of each.
    each = stage(spark, cut.select("slice", F.posexplode(F.arrays_zip("ids", "digests")).alias("text", "d"))
                 .select("slice", "text", "d.digests", F.coalesce("d.ids", F.lit(LAST)).alias("rank")), "op13-texts")
    copied = stage(spark, each.groupBy("digests").agg(F.min("rank").alias("low"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").drop("n"), "op13-classes")
    low = (each.join(copied, "digests", "left")
           .groupBy("slice").agg(F.sort_array(F.collect_list(
               F.struct("text", F.coalesce("low", "rank").alias("low")))).alias("low"))
           .select("slice", F.col("low.low").alias("low")))

    asked = cut.mapInArrow(_anchors(owners), "owner int, slice bigint, codes binary, many binary")
    answers = stage(spark, asked.repartitionById(owners, "owner").mapInArrow(
        _shared(hot_slices), "owner int, slice bigint, shared binary, hot binary"), "op13-answers")
    told = stage(spark, low.join(answers.groupBy("slice").agg(
        F.collect_list(F.struct("owner", "shared", "hot")).alias("answers")), "slice", "left"), "op13-told")

    sent = cut.join(told, "slice").mapInArrow(_sent(owners), _PIECES)
    first = stage(spark, sent.repartitionById(owners, "owner").mapInArrow(
        _refinement(pieces_at_once), "slice bigint, text binary, place binary, bits binary"), "op13-first")
    kept = first.groupBy("slice").agg(F.collect_list(F.struct("text", "place", "bits")).alias("first"))
    return cut.join(told, "slice").join(kept, "slice", "left").mapInArrow(_results(owners), _RESULT)


ORACLE = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
bytes as (
    select doc_id, unnest(range(1, len(h) // 2 + 1)) as i, h from d),
places as (
    select doc_id, i, substr(h, 2 * i - 1, 2) as byte,
           case when 2 * (i + 49) <= len(h) then substr(h, 2 * i - 1, 100) end as string
    from bytes),
judged as (
    select doc_id, i, byte,
           string is not null and min(doc_id) over (partition by string) < doc_id as starts
    from places),
covered as (
    select doc_id, i, byte,
           max(starts::int) over (partition by doc_id order by i rows between 49 preceding and current row) as gone
    from judged),
edges as (
    select *, gone = 1 and coalesce(lag(gone) over (partition by doc_id order by i), 0) = 0 as opens
    from covered),
found as (
    select doc_id, sum(gone) as n_removed, sum(opens::int) as n_spans,
           coalesce(string_agg(byte, '' order by i) filter (where gone = 0), '') as kept
    from edges group by doc_id)
select d.doc_id, cast(len(d.h) // 2 as bigint) as n_bytes,
       cast(coalesce(f.n_removed, 0) as bigint) as n_removed,
       cast(coalesce(f.n_spans, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(f.kept, ''))) as kept_sha256
from d left join found f using (doc_id)
"""
