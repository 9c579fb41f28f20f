"""License scan: winnowed fingerprints in an inverted index, banded alignment.

An occurrence of a template is a stretch of a text that has a given part of the
template's words in order.  It lacks at most e of them.  A template's words are
winnowed, with the largest window that leaves more than e places, so an
occurrence has a fingerprint at its place; the inverted index gives the
templates and places of each word of a text.  Where a stretch around such a hit
has enough words of the template, it is aligned within a band around the hit's
diagonal.  The band is what a stretch of the allowed length with so few words
missing can shift by, so no occurrence is lost.  The alignment is a longest
common subsequence whose rows are the bits of an integer.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import U64, mixed, slices, words

LEAST_WORDS = 3          # of a template
COVERAGE = 0.8           # of a template's words, to be reported
SLACK = 4                # words that a match may shift, at least; and a quarter of the template
STRETCH = 3              # times the template's words that an occurrence may take, at least
MAX_TEMPLATES = 10_000   # bounds the index that is broadcast; more is an error
SLICE = 4 << 20

# Notices and opening passages of public licenses.
TEMPLATES = [
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT-notice", "Released under the MIT License."),
    ("MIT-grant",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-header",
     "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of "
     "the License, or (at your option) any later version."),
    ("BSD-conditions",
     "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("ISC-grant",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("MPL-2.0-header",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("All-rights-reserved", "All rights reserved."),
]

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_EDGE = re.compile(r"^\W+|\W+$")
_STRUCT = T.StructType([
    T.StructField("template", T.StringType()), T.StructField("coverage", T.DoubleType()),
    T.StructField("matched", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType())])


def _plain(found: list[bytes]) -> list[str]:
    """Words in lower case, without punctuation at their ends."""
    return [_EDGE.sub("", w.decode("utf-8", "replace").lower()) for w in found]


def _hashes(plain: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in plain), U64, len(plain))


def winnowed(keys: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest key of every window (the last of equals)."""
    window = max(1, min(window, len(keys)))
    view = np.lib.stride_tricks.sliding_window_view(keys, window)
    return np.unique(np.arange(len(view)) + window - 1 - np.argmin(view[:, ::-1], axis=1))


class Index:
    """The templates, and for each word (by its place in the sorted vocabulary
    of all) the templates and places where it is a fingerprint."""

    def __init__(self, templates: list[tuple[str, str]], coverage: float = COVERAGE):
        self.names, hashed = [], []
        for name, text in templates:
            plain = [w for w in _plain(_WORD.findall((text or "").encode())) if w]
            if len(plain) < LEAST_WORDS:
                raise ValueError(f"template {name} has fewer than {LEAST_WORDS} words")
            hashed.append(_hashes(plain))
            self.names.append(name)
        self.vocabulary = np.unique(np.concatenate(hashed)) if hashed else np.empty(0, U64)
        self.templates = [Template(np.searchsorted(self.vocabulary, h), coverage) for h in hashed]
        posted = sorted((int(w), t) for t, own in enumerate(self.templates) for w in own.prints)
        word = np.array([w for w, _ in posted], np.int64)
        self.posted = np.array([t for _, t in posted], np.int64)
        self.first = np.searchsorted(word, np.arange(len(self.vocabulary) + 1))

    def places(self, h: np.ndarray) -> np.ndarray:
        """The place in the vocabulary of each hash, -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at, -1)

    def hits(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words, by their places in the vocabulary, each that is a
        fingerprint of a template: template and number of the word, by template."""
        count = np.diff(self.first)[v]
        number = np.repeat(np.arange(len(v)), count)
        of = np.arange(len(number)) - np.repeat(np.cumsum(count) - count, count) + self.first[v[number]]
        order = np.argsort(self.posted[of], kind="stable")
        return self.posted[of][order], number[order]


class Template:
    def __init__(self, words: np.ndarray, coverage: float):
        self.words = words
        self.own, self.times = np.unique(words, return_counts=True)
        n = len(words)
        self.need = next(k for k in range(n + 2) if k > 0 and (k >= coverage * n or k > n))
        self.width = max(n + 2 * (SLACK + n // 4), STRETCH * n)
        # of two words of an occurrence, how much farther apart or nearer they may be than in the template
        self.band = self.width - self.need
        self.forward: dict[int, int] = dict.fromkeys(self.own.tolist(), 0)
        self.backward = dict(self.forward)
        for i, w in enumerate(words.tolist()):
            self.forward[w] |= 1 << i
            self.backward[w] |= 1 << n - 1 - i
        keys = mixed(words.astype(U64) + U64(1))
        for window in range(n, 0, -1):
            places = winnowed(keys, window)
            if len(places) > n - self.need:      # an occurrence cannot lack them all
                break
        self.prints: dict[int, list[int]] = {}
        for i in places.tolist():
            self.prints.setdefault(int(words[i]), []).append(i)

    def possible(self, found: list[int], need: int) -> bool:
        """Whether ``found`` has as many words of the template, in any order."""
        n = Counter(found)
        return sum(min(n[w], int(k)) for w, k in zip(self.own.tolist(), self.times, strict=True)) >= need

    def bands(self, place: list[int], found: list[int]) -> list[tuple[int, int]]:
        """For each of the words ``found`` at ``place``, the places of the
        template in the bands around the diagonals of the hits near it, as bits
        from the first and from the last."""
        hits = [(j, j - i) for j, w in zip(place, found, strict=True) for i in self.prints.get(w, ())]
        at, n = [j for j, _ in hits], len(self.words)
        out = []
        for j in place:
            near = [s for _, s in hits[bisect_right(at, j - self.width):bisect_left(at, j + self.width)]]
            lo, hi = (max(0, j - max(near) - self.band), min(n - 1, j - min(near) + self.band)) \
                if near else (0, -1)
            bits = (1 << max(0, hi - lo + 1)) - 1
            out.append((bits << lo, bits << max(0, n - 1 - hi)))
        return out

    def aligned(self, place: list[int], found: list[int], bands: list[tuple[int, int]], lo: int, hi: int,
                need: int) -> tuple[int, int] | None:
        """Of the words ``found`` at ``place`` from ``lo`` to before ``hi``, the
        stretch that ends first with ``need`` words of the template in order,
        within their bands, and is no longer than the width; of those the one
        that begins last."""
        n = len(self.words)
        full = (1 << n) - 1
        while hi - lo >= need:
            rest, end = full, -1
            for k in range(lo, hi):
                hit = rest & self.forward[found[k]] & bands[k][0]
                rest = (rest + hit | rest - hit) & full
                if n - rest.bit_count() >= need:
                    end = k
                    break
            if end < 0:
                return None
            rest = full
            for k in range(end, lo - 1, -1):
                hit = rest & self.backward[found[k]] & bands[k][1]
                rest = (rest + hit | rest - hit) & full
                if n - rest.bit_count() >= need:
                    if place[end] - place[k] < self.width:
                        return k, end
                    break
            # what begins here is too long; what ends later begins later
            lo = bisect_left(place, place[end] - self.width + 1, lo, hi)
        return None

    def occurrences(self, place: list[int], found: list[int]) -> list[tuple[int, int, int]]:
        """Matched words, first and last place of the occurrences among the words
        ``found`` of the template at ``place``: as many as there are without
        overlap, each with as many words as fit between its neighbours."""
        bands = self.bands(place, found)
        shortest, at = [], 0
        while (one := self.aligned(place, found, bands, at, len(found), self.need)) is not None:
            shortest.append(one)
            at = one[1] + 1
        out, lo = [], 0
        for i in range(len(shortest)):
            hi = shortest[i + 1][0] if i + 1 < len(shortest) else len(found)
            best, n = shortest[i], self.need
            # what is longer and lies between the neighbours overlaps the shortest
            lo = bisect_left(place, place[best[0]] - self.width + 1, lo)
            hi = bisect_left(place, place[best[1]] + self.width, lo, hi)
            for more in range(len(self.words), self.need, -1):
                if self.possible(found[lo:hi], more) \
                        and (one := self.aligned(place, found, bands, lo, hi, more)):
                    best, n = one, more
                    break
            out.append((n, place[best[0]], place[best[1]]))
            lo = best[1] + 1
        return out


def _matches(index: Index, v: np.ndarray, at: np.ndarray) -> dict[int, list]:
    """Per document with any, (template, coverage, matched words, first and last
    word) of its occurrences.  ``v`` has the places in the vocabulary of the
    words of all documents, ``at`` the first word of each document and the end."""
    known = np.flatnonzero(v >= 0)
    by_word = known[np.argsort(v[known], kind="stable")]
    counts = np.bincount(v[known], minlength=len(index.vocabulary))
    begin = np.concatenate([[0], np.cumsum(counts)])

    out: dict[int, list] = {}
    of, hits = index.hits(v[known])
    hits = known[hits]
    cut = np.searchsorted(of, np.arange(len(index.templates) + 1))
    for t, template in enumerate(index.templates):
        hit = hits[cut[t]:cut[t + 1]]
        if not len(hit) or np.minimum(counts[template.own], template.times).sum() < template.need:
            continue
        own = np.sort(np.concatenate([by_word[begin[w]:begin[w + 1]] for w in template.own]))
        doc = np.searchsorted(at, hit, side="right") - 1
        lo = np.searchsorted(own, np.maximum(hit - template.width + 1, at[doc]))
        hi = np.searchsorted(own, np.minimum(hit + template.width, at[doc + 1]))
        enough = hi - lo >= template.need
        doc, lo, hi = doc[enough], lo[enough], hi[enough]
        if not len(lo):
            continue
        # hits whose surroundings overlap are one region
        new = np.flatnonzero(np.concatenate([[True], (lo[1:] >= hi[:-1]) | (doc[1:] != doc[:-1])]))
        for d, a, b in zip(doc[new].tolist(), lo[new].tolist(),
                           hi[np.append(new[1:], len(lo)) - 1].tolist(), strict=True):
            place = own[a:b]
            found = v[place].tolist()
            if template.possible(found, template.need):
                for n, first, last in template.occurrences((place - at[d]).tolist(), found):
                    out.setdefault(d, []).append((t, n / len(template.words), n, first, last))
    return {d: sorted(x, key=lambda x: (x[3], x[0])) for d, x in out.items()}


def _scanned(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = sent.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found, place, offsets = words(part.column("text"))
                plain = _plain(found)
                keep = np.fromiter(map(bool, plain), bool, len(plain))[place] if found else np.empty(0, bool)
                v = index.places(_hashes(plain))[place] if found else np.empty(0, np.int64)
                at = np.concatenate([[0], np.cumsum(keep)])[offsets]
                nth = np.arange(len(v)) - np.repeat(offsets[:-1], np.diff(offsets))
                v, nth = v[keep], nth[keep]    # words with a letter or digit, and which of all words
                matches = _matches(index, v, at)
                out: list = []
                for i in range(part.num_rows):
                    rows, lo = matches.get(i, []), int(at[i])
                    if rows:
                        raw = part.column("text")[i].as_py().encode()
                        spans = [m.span() for m in _WORD.finditer(raw)]
                        rows = [(index.names[t], c, n, len(raw[:spans[nth[lo + a]][0]].decode()),
                                 len(raw[:spans[nth[lo + b]][1]].decode())) for t, c, n, a, b in rows]
                    out.append([dict(zip(_STRUCT.names, r, strict=True)) for r in rows])
                kind = pa.list_(pa.struct([("template", pa.string()), ("coverage", pa.float64()),
                                           ("matched", pa.int32()), ("start", pa.int64()),
                                           ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, kind)],
                                                 ["doc_id", "matches"])
    return run


def license_scan(spark: SparkSession, docs: DataFrame, templates: DataFrame | None = None,
                 coverage: float = COVERAGE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and matches, an array of
    template, coverage (part of the template's words that are there, in order),
    matched (their number), start and end (code points, end exclusive), by
    start.

    ``templates`` (template, text) replaces the built-in ones; a template needs
    three words.  Words are compared in lower case without punctuation at their
    ends.  An occurrence may have other words in between: it takes up to
    STRETCH times as many words as the template, or twice the shift more if that
    is longer.  As many occurrences of a template are given as there are without
    overlap; those of different templates may overlap.  Null and empty texts
    have no matches, repeated rows the same ones; an empty table gives an empty
    result.
    """
    known = TEMPLATES
    if templates is not None:
        rows = templates.select("template", "text").limit(MAX_TEMPLATES + 1).collect()
        if len(rows) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        known = [(r["template"], r["text"]) for r in rows]
    sent = spark.sparkContext.broadcast(Index(known, coverage))
    return docs.select("doc_id", "text").mapInArrow(_scanned(sent), T.StructType([
        docs.schema["doc_id"], T.StructField("matches", T.ArrayType(_STRUCT))]))


def by_license(found: DataFrame) -> DataFrame:
    """A row per document: its best match of each template, and how many."""
    return found.select("doc_id", F.size("matches").alias("n_matches"), "matches")
