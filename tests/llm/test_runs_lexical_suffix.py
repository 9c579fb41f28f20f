"""Periodic runs, ranked lexical search and repeated passages against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from strata.llm import lexical_search as lx
from strata.llm import periodic_runs as pr
from strata.llm import queries
from strata.llm import suffix_dedup as sd

WHITE = re.compile(r"[\x20\x09-\x0D]+")


# Periodic runs ---------------------------------------------------------------

def plain_runs(words, least=24, times=3):
    """Every maximal stretch of every period, of equal stretches the smallest."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng, n, letters):
    words = rng.integers(0, letters, n)
    if n > 5 and rng.random() < 0.6:
        period, start = int(rng.integers(1, 9)), int(rng.integers(0, n))
        words[start:] = np.resize(words[start:start + period], n - start)
    return words


def test_runs_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(400):
        texts = [random_words(rng, int(rng.integers(0, 70)), int(rng.integers(1, 4)))
                 for _ in range(rng.integers(0, 5))]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        words = np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.int64)
        least, times = int(rng.integers(2, 26)), int(rng.integers(2, 4))
        got = pr.runs(words, offsets, least, times, candidates=int(rng.integers(1, 300)))
        want = [(t, *r) for t, w in enumerate(texts) for r in plain_runs(w.tolist(), least, times)]
        assert [tuple(r) for r in got.tolist()] == want


def test_extensions_equal_comparison():
    rng = np.random.default_rng(6)
    for _ in range(60):
        words = random_words(rng, int(rng.integers(2, 200)), int(rng.integers(1, 4)))
        lined = np.concatenate([[-1], words, [-2]]).astype(np.int64)
        levels = pr.grammar(lined)
        assert len(levels[-1].symbol) == 3
        x, y = np.array([(a, b) for a in range(1, len(words) + 1) for b in range(a + 1, len(words) + 1)]).T
        for step in (1, -1):
            def plain(a, b):
                n = 0
                while lined[a + step * n] == lined[b + step * n]:
                    n += 1
                return n
            assert pr.extension(levels, x, y, step).tolist() == [plain(a, b) for a, b in zip(x, y, strict=True)]


def test_grammar_shrinks():
    words = np.random.default_rng(7).integers(0, 50, 20_000)
    levels = pr.grammar(np.concatenate([[-1], words, [-2]]))
    assert len(levels) < 80
    assert sum(len(level.symbol) for level in levels) < 10 * len(words)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def described(doc_id, text):
    words = planted(doc_id, [w for w in WHITE.split(text or "") if w])
    found = plain_runs(words)
    keep = [not any(s + q <= i < s + n for s, n, q in found) for i in range(len(words))]
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    return (len(found), *top, top[1] * 1000 // top[2] if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for w, k in zip(words, keep, strict=True) if k).encode()).hexdigest())


def texts_with_runs():
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ab " * 23), (5, "ab " * 24), (6, " a b\x0bc" * 9),
            (7, "é " * 40 + "x " + "é " * 40), (8, "a b " * 12 + "a c " * 12), (8, "z " * 30), (8, "z " * 30)]
    for i in range(60):
        words = [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 400))]
        if i % 3 == 0:
            p = rng.randint(1, 40)
            words[rng.randint(0, len(words)):] = (words[:p] or ["q"]) * rng.randint(2, 9)
        rows.append((100 + i, (" " if i % 2 else "\n").join(words)))
    rows.append((200, "long " * 60_000))
    return rows


def test_query_of_runs_equals_brute_force(spark, docs_of, tmp_root):
    rows = [r for r in texts_with_runs() if r[0] != 200]
    docs_of(rows).write.parquet(f"{tmp_root}/documents.parquet")
    got = queries.all_queries()["op12_periodic_runs"](spark, tmp_root).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr((d, *described(d, t))) for d, t in rows)


def test_runs_of_long_null_and_repeated_rows(spark, docs_of):
    rows = [*texts_with_runs(), (None, "x y " * 20)]
    got = {}
    for r in pr.periodic_runs(docs_of(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[8]) == 3
    assert got[200][0].runs == [(0, 60_000, 1)] and got[200][0].collapsed == "long"
    assert [tuple(x) for x in got[None][0].runs] == [(0, 40, 2)] and got[None][0].collapsed == "x y"
    assert got[0][0].runs == [] and got[0][0].top is None and got[0][0].collapsed == ""
    assert pr.periodic_runs(docs_of([])).count() == 0


# Ranked lexical search -----------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranking(docs, items, k=10):
    split = [(d, plain_terms(t)) for d, t in docs]
    count, total = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df = {}
    for _, t in split:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = set()
    for item, text in items:
        scored = []
        for d, t in split:
            m = 10 + 90 * len(t) * count // total if total else 10
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1)))
                        * (10**9 * t.count(w) // (1000 * t.count(w) + 8 * m))
                        for w in set(plain_terms(text)) if w in df and w in t)
            if score > 0:
                scored.append((-score, d))
        out |= {(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])}
    return out


def search_rows(seed=3, n=400):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(300)] + ["École", "naïve", "x1", "日本"]
    docs = [(i, rng.choice([" ", "-", "\n", "_"]).join(rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1),
                                                                 k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "!? ,"), (n + 3, docs[5][1]), (n + 4, docs[5][1]),
             (n + 5, " ".join(vocabulary * 300))]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12))).upper()) for i in range(40)]
    return docs, [*items, (900, None), (901, "..."), (902, "unseen"), (903, docs[5][1])]


def found(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture()
def items_of(spark):
    return lambda rows: spark.createDataFrame([(i, t, "w", 1) for i, t in rows],
                                              "item_id bigint, text string, rank string, doc_id int")


@pytest.mark.parametrize("growth, terms, slice_bytes", [(16, 1 << 13, 1 << 22), (2, 40, 2_000), (3, 1, 500)])
def test_ranking_equals_brute_force(spark, docs_of, items_of, monkeypatch, growth, terms, slice_bytes):
    monkeypatch.setattr(lx, "SLICE", slice_bytes)
    docs, items = search_rows()
    if terms == 1:
        items = items[::9]
    got = found(lx.ranked(spark, docs_of(docs), items_of(items), growth=growth, block_terms=terms))
    assert got == plain_ranking(docs, items)


def test_ranking_of_nulls_repeats_and_empty_tables(spark, docs_of, items_of):
    docs = [(3, "a b"), (3, "a b"), (None, "a b"), (1, "a b c"), (2, "z")]
    got = [tuple(r) for r in lx.ranked(spark, docs_of(docs), items_of([(7, "a"), (None, "b"), (8, "z"), (8, "a")]))
           .orderBy("item_id", "rank").collect()]
    assert [(r[0], r[1], r[2]) for r in got] == [(7, 1, 3), (7, 2, 3), (7, 3, None), (7, 4, 1),
                                                (8, 1, 3), (8, 2, 3), (8, 3, None), (8, 4, 1)]
    assert lx.ranked(spark, docs_of([]), items_of([(1, "a")])).count() == 0
    assert lx.ranked(spark, docs_of(docs), items_of([])).count() == 0
    assert lx.ranked(spark, docs_of([(1, None)]), items_of([(1, "a")])).count() == 0


def test_pairs_of_nodes_are_skipped():
    """Documents of separate topics: most pairs are never scored, none of the best is lost."""
    rng = np.random.default_rng(1)
    topic = np.repeat(np.arange(16), 64)
    vectors = np.zeros((1024, 160))
    for row, t in enumerate(topic):
        vectors[row, t * 10:t * 10 + 10] = rng.integers(1, 1000, 10)
    weights = np.zeros((16, 160))
    for t in range(16):
        weights[t, t * 10:t * 10 + 10] = rng.integers(1, 9000, 10)
    order = rng.permutation(1024)
    vectors, ids = vectors[order], np.arange(1024)
    best = lx._Best(np.stack([np.zeros(16, np.int64), np.full(16, lx.LAST)], axis=1), 10)
    items, docs = lx.build(weights, np.ones(160), lx.ITEM_LEAF), lx.build(vectors, weights.max(axis=0), lx.DOC_LEAF)
    scored = lx.search(items, weights, docs, vectors, ids, best)
    assert scored < 16 * 1024 / 2
    for t in range(16):
        scores = (vectors @ weights[t]).astype(np.int64)
        want = sorted(zip(-scores, ids, strict=True))[:10]
        assert [(-s, i) for s, i in want] == [tuple(x) for x in best.found[t].tolist()]


def test_bound_of_a_node_pair_holds():
    rng = np.random.default_rng(2)
    vectors, weights = rng.integers(0, 9, (100, 12)).astype(float), rng.integers(0, 9, (30, 12)).astype(float)
    items, docs = lx.build(weights, np.ones(12), 4), lx.build(vectors, np.ones(12), 8)
    for i, (a, b) in enumerate(items.span):
        for d, (lo, hi) in enumerate(docs.span):
            most = (vectors[docs.order[lo:hi]] @ weights[items.order[a:b]].T).max()
            assert items.maxima[i] @ docs.maxima[d] >= most


# Repeated passages -----------------------------------------------------------

def plain_removal(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of what is left) of each row."""
    raw = [((math.inf if d is None else d), (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in raw:
        for i in range(len(b) - 49):
            s = b[i:i + 50]
            least[s] = min(least.get(s, d), d)
    out = []
    for (d, b), (doc_id, _) in zip(raw, rows, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if least[b[i:i + 50]] < d:
                gone[i:i + 50] = b"\x01" * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def removed(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
                   for r in df.collect()), key=repr)


def passages(seed=4):
    rng = random.Random(seed)

    def prose(n):
        return " ".join(rng.choice(["the", "é", "of", "and", "naïve", "ab", "x"]) + str(rng.randint(0, 99))
                        for _ in range(n))
    common = [prose(30) for _ in range(6)] + ["a short line that is common to many of the texts, 1234"]
    texts = [None, "", "short", "x" * 49, "x" * 50, "x" * 300, "ab" * 200, "é" * 60, common[0]]
    for _ in range(120):
        own = prose(rng.randint(0, 60))
        for c in rng.sample(common, rng.randint(0, 3)):
            at, cut = rng.randint(0, len(own)), rng.randint(0, len(c) // 2)
            own = own[:at] + c[cut:] + own[at:]
        texts.append(own)
    texts += [texts[20], texts[20], texts[21] + "y", "z" + texts[21], "x" * 120 + texts[30], prose(9000)]
    return list(zip(rng.sample(range(1000), len(texts)), texts, strict=True))


@pytest.mark.parametrize("hot, slice_bytes, at_once, windows",
                         [(1 << 12, 1 << 22, 1 << 14, 1 << 18), (1, 3_000, 7, 64), (3, 20_000, 100, 1_000)])
def test_removal_equals_brute_force(spark, docs_of, monkeypatch, hot, slice_bytes, at_once, windows):
    monkeypatch.setattr(sd, "SLICE", slice_bytes)
    monkeypatch.setattr(sd, "WINDOWS", windows)
    rows = passages()
    assert removed(sd.without_repeats(spark, docs_of(rows), hot, at_once)) == plain_removal(rows)


def test_removal_of_nulls_and_repeated_rows(spark, docs_of):
    a, b = "passage number one " * 6, "another passage " * 8
    rows = [(5, a), (5, a), (5, a + b), (7, b), (None, a), (None, a), (None, "q" + b), (None, "q" + b + "!"), (9, a + "é")]
    assert removed(sd.without_repeats(spark, docs_of(rows))) == plain_removal(rows)
    only = [(None, a), (None, a + "!"), (None, a)]
    assert removed(sd.without_repeats(spark, docs_of(only))) == plain_removal(only)
    assert all(r[2] == 0 for r in plain_removal(only))
    assert sd.without_repeats(spark, docs_of([])).count() == 0


def test_spans_are_the_removed_bytes(spark, docs_of):
    rows = passages(9)
    text = {d: (t or "").encode() for d, t in rows}
    for r in sd.without_repeats(spark, docs_of(rows)).collect():
        left, at = b"", 0
        for s, e in r.spans:
            assert at < s or at == s == 0
            left, at = left + text[r.doc_id][at:s], e
        assert left + text[r.doc_id][at:] == bytes(r.kept)


def test_refined_buckets_equal_sorting():
    rng = np.random.default_rng(3)
    for _ in range(50):
        spans = [rng.integers(97, 97 + rng.integers(1, 4), rng.integers(50, 81)).astype(np.uint8).tobytes()
                 for _ in range(rng.integers(1, 12))]
        spans += spans[:2]
        data = np.frombuffer(b"".join(spans), np.uint8)
        size = np.array([len(s) for s in spans])
        room = np.repeat(np.cumsum(size), size) - np.arange(len(data))
        pointer = sd.refined(data, room)
        where = np.flatnonzero(room >= 50)
        strings = {}
        for s in where.tolist():
            strings.setdefault(data[s:s + 50].tobytes(), set()).add(int(pointer[s]))
        assert all(len(p) == 1 for p in strings.values())
        assert len(set().union(*strings.values())) == len(strings)


def test_anchors_follow_the_string_only():
    """Equal strings have the anchor of one hash, wherever they stand and however the work is cut."""
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    ends = np.array([700, 700, 740, 2000, 3000])
    whole = None
    for windows in (1 << 18, 100):
        text, at, count, key = sd.pieces(data, ends, windows)
        anchor = {}
        for t, a, n, h in zip(text.tolist(), at.tolist(), count.tolist(), key.tolist(), strict=True):
            assert 1 <= n <= sd.WIDTH and a + n + 49 <= ends[t] and a >= (ends[t - 1] if t else 0)
            for i in range(a, a + n):
                assert i not in anchor
                anchor[i] = h
        want = {i for lo, hi in zip([0, *ends[:-1]], ends, strict=True) for i in range(lo, hi - 49)}
        assert set(anchor) == want
        by_string = {}
        for i, h in anchor.items():
            assert by_string.setdefault(data[i:i + 50].tobytes(), h) == h
        assert whole in (None, anchor)
        whole = anchor
