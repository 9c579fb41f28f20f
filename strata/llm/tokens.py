"""Token ids of whole Arrow columns of text, with a public byte-level BPE.

A piece of the tokenizer's split never spans a single space that stands between
two other characters: the space opens the next piece.  So a text is cut at
single spaces, every distinct word of a batch is encoded once (all of them in
one call, told apart by the tokens that begin with a space), and the texts are
put together from them.  Texts with other white space at a cut are encoded
whole.  The ids are those of the ``tokenizers`` file of the same vocabulary.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words encoded in one call.
RUN = 100_000


class Encoder:
    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken
        ranks = {base64.b64decode(token): int(rank) for token, rank in
                 map(bytes.split, Path(ranks_path).read_bytes().splitlines())}
        self.n_vocab = max(ranks.values()) + 2  # and one for the end of a text
        self._encode = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        size = self.n_vocab
        self.opens = np.zeros(size, bool)       # begins with a space
        self.white = np.zeros(size, bool)       # begins with any white space
        self.stops = np.zeros(size, bool)       # ends a sentence
        for token, rank in ranks.items():
            self.opens[rank] = token[:1] == b" "
            self.white[rank] = token[:1].isspace()
            self.stops[rank] = token.rstrip()[-1:] in (b".", b"!", b"?") or b"\n" in token

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._encode(text), np.uint32)

    def _words(self, found: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of the words, each with a space before it, and their numbers."""
        ids, sizes = [], []
        for at in range(0, len(found), RUN):
            part = found.slice(at, RUN)
            run = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
            run = self.encode(" " + pc.binary_join(run, " ")[0].as_py())
            starts = np.flatnonzero(self.opens[run])
            ids.append(run)
            sizes.append(np.diff(starts, append=len(run)))
        return ids, np.concatenate(sizes) if sizes else np.empty(0, np.int64)

    def _parts(self, text: pa.Array):
        """Ids and sizes of the distinct parts, the part at each place, and the
        offsets of the texts in these places."""
        split = pc.split_pattern(pc.fill_null(text, ""), " ")
        flat, offsets = split.flatten(), np.asarray(split.offsets).astype(np.int64)
        offsets = offsets - offsets[0]
        coded = pc.dictionary_encode(flat)
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        index, found = np.asarray(coded.indices).astype(np.int64), coded.dictionary
        # white space at an end, or nothing: not to be cut there
        cut = np.asarray(pc.or_(pc.equal(found, ""), pc.or_(
            pc.not_equal(found, pc.utf8_trim_whitespace(found)),
            pc.match_substring_regex(found, "^[\\x1c-\\x1f]|[\\x1c-\\x1f]$"))))
        safe = np.flatnonzero(~cut)
        ids, sizes = self._words(found.take(pa.array(safe)))
        size_of = np.zeros(len(found), np.int64)
        size_of[safe] = sizes
        n = len(offsets) - 1
        alone = np.diff(offsets) == 1  # no space in it
        whole = np.zeros(n, bool)
        if n:
            whole = np.logical_or.reduceat(cut[index], offsets[:-1]) & ~alone
        firsts = []
        for i in np.flatnonzero(whole):
            firsts.append((i, self.encode(text[int(i)].as_py())))
        rest = np.flatnonzero(~whole)
        for i, word in zip(rest, found.take(pa.array(index[offsets[rest]])).to_pylist(), strict=True):
            firsts.append((i, self.encode(word)))
        firsts.sort(key=lambda x: x[0])
        # places: the first part of a text, then its words; texts encoded whole have no words
        keep = np.ones(len(index), bool)
        keep[offsets[:-1]] = False
        if whole.any():
            keep &= ~np.repeat(whole, np.diff(offsets))
        keep[offsets[:-1]] = True
        place = index.copy()
        place[offsets[:-1]] = len(found) + np.arange(n)
        at = np.concatenate([[0], np.cumsum(keep)])[offsets]
        return (ids + [x for _, x in firsts],
                np.concatenate([size_of, np.fromiter((len(x) for _, x in firsts), np.int64, n)]),
                place[keep], at)

    def lengths(self, text: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        _, sizes, place, at = self._parts(text)
        return np.diff(np.concatenate([[0], np.cumsum(sizes[place])])[at])

    def ids(self, text: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after the other, each with ``end`` behind
        it, and the offsets of the texts in them."""
        ids, sizes, place, at = self._parts(text)
        pool = np.concatenate([*ids, np.array([end], np.uint32)])
        sizes = np.append(sizes, 1)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place = np.insert(place, at[1:], len(sizes) - 1)
        at = at + np.arange(len(at))
        size = sizes[place]
        upto = np.concatenate([[0], np.cumsum(size)])
        out = pool[np.repeat(starts[place] - upto[:-1], size) + np.arange(upto[-1])]
        return out, upto[at]


@lru_cache(maxsize=2)
def encoder(ranks_path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(ranks_path)


def public_ranks() -> str:
    """Path of the public 50k vocabulary as ranks."""
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
