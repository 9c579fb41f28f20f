"""Periodic runs of words by recompression.

A run is a maximal stretch of words with period q that is at least three
periods and 24 words long.  The texts of a slice become one run-length grammar:
block compression (a^r becomes one symbol) and pair compression (an adjacent
pair of a left and a right symbol becomes one symbol) alternate until each text
is a single symbol.  What a symbol covers depends on its words only, so two
equal stretches are parsed alike but for a few symbols at their ends; the
longest common extension of two places climbs the levels while the symbols
agree and descends where they differ, a step or two per level.

Candidates are places on a harmonic grid: a run of period q holds a multiple of
its least length less q, whatever its place, so a place in every 2 q words and
its partner q words on find it.  Extending the pair to both sides gives the run
exactly.  All places of a slice are extended at once, level by level.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import U64, mixed, slices

LEAST = 24               # words of a run
TIMES = 3                # periods of a run
SLICE = 1 << 20
CANDIDATES = 1 << 20     # extended at once

Rearrange = Callable[[list, np.ndarray], np.ndarray]


@dataclass
class Level:
    symbol: np.ndarray            # names; marks between texts are negative, each its own
    first: np.ndarray             # first child, one level down, of each symbol, and the end
    blocks: bool                  # made by block compression, else by pair compression
    up: np.ndarray | None = None  # the symbol one level up that holds each symbol


def _named(high: np.ndarray, low: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """New names, from ``fresh`` on, for the pairs (high, low), equal for equal pairs."""
    distinct, name = np.unique(high.astype(np.int64) << 32 | low.astype(np.int64), return_inverse=True)
    return fresh + name.reshape(-1), fresh + len(distinct)


def _risen(levels: list[Level], starts: np.ndarray, symbol: np.ndarray, blocks: bool) -> None:
    """Add the level whose symbols begin at ``starts`` (a mask) of the last one."""
    levels[-1].up = np.cumsum(starts) - 1
    first = np.append(np.flatnonzero(starts), len(starts))
    levels.append(Level(symbol, first, blocks))


def grammar(words: np.ndarray) -> list[Level]:
    """The levels of the grammar of ``words``: non-negative names of the words
    of all texts, with a negative mark of its own before, between and after
    texts."""
    fresh = int(words.max(initial=0)) + 1
    levels = [Level(words.astype(np.int64), np.arange(len(words) + 1), False)]
    turn = 0
    while True:
        s = levels[-1].symbol
        differs = np.append(True, s[1:] != s[:-1])
        if not differs.all():
            begin = np.flatnonzero(differs)
            count = np.diff(np.append(begin, len(s)))
            symbol, many = s[begin], count > 1
            symbol[many], fresh = _named(symbol[many], count[many], fresh)
            _risen(levels, differs, symbol, True)
            s = symbol
        inner = (s[1:] >= 0) & (s[:-1] >= 0)
        if not inner.any():
            return levels
        # Each symbol is left or right by a hash; of the two ways the one with more pairs.
        turn += 1
        right = (mixed(s.astype(U64) + U64(turn << 40)) >> U64(63)).astype(bool)
        ways = (inner & ~right[:-1] & right[1:], inner & right[:-1] & ~right[1:])
        pairs = max(ways, key=np.count_nonzero)
        if not pairs.any():
            continue             # another hash
        starts = np.append(True, ~pairs)
        symbol, second = s[starts], np.flatnonzero(pairs) + 1
        names, fresh = _named(s[second - 1], s[second], fresh)
        symbol[(np.cumsum(starts) - 1)[second]] = names
        _risen(levels, starts, symbol, False)


def extension(levels: list[Level], x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from the places x and y on (x != y, both included),
    to the right (``step`` 1) or to the left (-1).  Texts end at their marks."""

    def edge(level: Level, parent: np.ndarray) -> np.ndarray:
        return level.first[parent] if step > 0 else level.first[parent + 1] - 1

    def left_over(level: Level, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        return level.first[parent + 1] - child if step > 0 else child - level.first[parent] + 1

    who, a, b = np.arange(len(x)), x, y
    stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low, high in zip(levels[:-1], levels[1:], strict=True):
        same = low.symbol[a] == low.symbol[b]
        out = [who[~same]], [a[~same]], [b[~same]]
        who, a, b = who[same], a[same], b[same]
        pa_, pb = low.up[a], low.up[b]
        inside = (edge(high, pa_) != a) | (edge(high, pb) != b)
        if inside.any():         # on to where both begin a symbol of the next level
            ax, bx = a[inside], b[inside]
            move = np.minimum(left_over(high, pa_[inside], ax), left_over(high, pb[inside], bx)) \
                if high.blocks else 1
            a[inside], b[inside] = ax + step * move, bx + step * move
            same = ~inside
            same[inside] = low.symbol[a[inside]] == low.symbol[b[inside]]
            for kept, of in zip(out, (who, a, b), strict=True):
                kept.append(of[~same])
            who, a, b = who[same], a[same], b[same]
        stopped.append(tuple(np.concatenate(o) for o in out))
        a, b = low.up[a], low.up[b]
    for k in range(len(levels) - 1, 0, -1):  # down to where they differ in words
        low, high = levels[k - 1], levels[k]
        ca, cb = edge(high, a), edge(high, b)
        same = low.symbol[ca] == low.symbol[cb]
        if same.any():
            move = np.minimum(left_over(high, a[same], ca[same]), left_over(high, b[same], cb[same])) \
                if high.blocks else 1
            ca[same], cb[same] = ca[same] + step * move, cb[same] + step * move
        who, a, b = (np.concatenate(z) for z in zip((who, ca, cb), stopped[k - 1], strict=True))
    length = np.zeros(len(x), np.int64)
    length[who] = np.abs(a - x[who])
    return length


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``count`` items of each group: the group and the number in it."""
    group = np.repeat(np.arange(len(count)), count)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)


def runs(words: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES,
         candidates: int = CANDIDATES) -> np.ndarray:
    """All runs of the texts words[offsets[t]:offsets[t + 1]]: rows of text,
    start (in its text), length and smallest period, by text, start and period."""
    n = np.diff(offsets)
    texts = len(n)
    lined = np.empty(len(words) + texts + 1, np.int64)
    begin = offsets[:-1] + np.arange(texts) + 1
    mark = np.append(begin - 1, len(lined) - 1)
    lined[mark] = -1 - np.arange(texts + 1)
    real = np.ones(len(lined), bool)
    real[mark] = False
    lined[real] = words
    long = np.flatnonzero(n >= least)
    if not len(long):
        return np.empty((0, 4), np.int64)
    text, q = _spread(n[long] // times)
    text, q = long[text], q + 1
    grid = np.maximum(least, times * q) - q
    count = -(-(n[text] - q) // grid)
    found, levels = [], None
    cut = np.searchsorted(np.cumsum(count), np.arange(candidates, int(count.sum()) + candidates, candidates),
                          side="right")
    for lo, hi in zip(np.append(0, cut[:-1]), cut, strict=True):
        of, number = _spread(count[lo:hi])
        of += lo
        x = begin[text[of]] + number * grid[of]
        y = x + q[of]
        equal = lined[x] == lined[y]
        if not equal.any():
            continue
        x, y, of = x[equal], y[equal], of[equal]
        levels = levels or grammar(lined)
        back = extension(levels, x - 1, y - 1, -1)
        length = back + extension(levels, x, y, 1) + q[of]
        full = length >= np.maximum(least, times * q[of])
        found.append(np.stack([text[of], x - back - begin[text[of]], length, q[of]], axis=1)[full])
    if not found:
        return np.empty((0, 4), np.int64)
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 3], every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), bool)          # of a stretch's periods the smallest
    new[1:] = (every[1:, :3] != every[:-1, :3]).any(axis=1)
    every = every[new]
    return every[np.lexsort((every[:, 3], every[:, 1], every[:, 0]))]


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                       T.StructField("runs", T.ArrayType(RUN)), T.StructField("top", RUN),
                       T.StructField("collapsed", T.StringType())])
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def _found(rearrange: Rearrange | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield _slice_runs(part, rearrange)
    return run


def _slice_runs(part: pa.RecordBatch, rearrange: Rearrange | None) -> pa.RecordBatch:
    split = pc.ascii_split_whitespace(pc.fill_null(part.column("text"), ""))
    flat, at = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    full = np.asarray(pc.binary_length(flat)) > 0        # white space at an end of a text
    offsets = np.concatenate([[0], np.cumsum(full)])[at - at[0]]
    flat = flat.filter(pa.array(full))
    if rearrange is not None:
        flat = flat.take(pa.array(rearrange(part.column("doc_id").to_pylist(), offsets)))
    words = np.asarray(flat.dictionary_encode().indices).astype(np.int64)
    found = runs(words, offsets)
    change = np.zeros(len(words) + 1, np.int64)          # words in a run after its first period
    begin = offsets[found[:, 0]] + found[:, 1]
    np.add.at(change, begin + found[:, 3], 1)
    np.add.at(change, begin + found[:, 2], -1)
    keep = np.cumsum(change[:-1]) == 0
    kept = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32)), flat.filter(pa.array(keep)))
    bounds = np.searchsorted(found[:, 0], np.arange(part.num_rows + 1))
    top = [None] * part.num_rows
    for t in np.unique(found[:, 0]).tolist():
        best = min(found[bounds[t]:bounds[t + 1], 1:].tolist(),
                   key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        top[t] = dict(zip(("start", "length", "period"), best, strict=True))
    listed = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(
        [pa.array(found[:, k]) for k in (1, 2, 3)], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(np.diff(offsets)), listed, pa.array(top, _RUN),
         pc.binary_join(kept, " ")], ["doc_id", "n_words", "runs", "top", "collapsed"])


def periodic_runs(docs: DataFrame, rearrange: Rearrange | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, runs (start, length,
    period, by start and period), top (the run with most periods; ties: smallest
    start, then period) and collapsed (the words that no run holds after its
    first period, joined by a space).

    Words are runs of characters other than ASCII white space.  ``rearrange``
    gets the ids and the word offsets of a slice of texts and returns, for each
    word, the number of the word to put there.  Null and empty texts have no
    word and no run; a null doc_id stays null; each of repeated rows has its
    row; an empty table gives an empty result.  Other columns are ignored.  A
    text is worked on as a whole; memory follows the longest.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_found(rearrange), SCHEMA)


def repeating(doc_ids: list, offsets: np.ndarray) -> np.ndarray:
    """A rearrangement that plants periods, for texts whose id says so: with h
    the CRC-32 of the decimal id and g = h // 10, the words from number a = g % n
    on repeat the first 1 + (n - a) // (3 + g % 8) of them if h % 10 = 0."""
    place = np.arange(offsets[-1])
    for doc, lo, hi in zip(doc_ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        h = 1 if doc is None else zlib.crc32(str(doc).encode())
        if h % 10 == 0 and hi > lo:
            g, n = h // 10, hi - lo
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            place[lo + a:hi] = lo + a + np.arange(n - a) % period
    return place


def described(runs: Column) -> Column:
    """The runs as lines of start,length,period."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")
