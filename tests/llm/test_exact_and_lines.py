"""Exact and line dedup against brute force and their oracle SQL."""

import hashlib
import random
import re
from collections import defaultdict

from strata.llm import exact_dedup as ed
from strata.llm import line_dedup as ld

WHITE = "[\x20\x09-\x0D]+"


def brute_exact(rows):
    """(doc_id, keep_id, group_size, kept, sha) of every row, sorted."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(WHITE, " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        some = [i for i in ids if i is not None]
        keep = min(some) if some else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = first and i != keep
    return sorted(out, key=str)


def exact_rows(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
                   for r in df.collect()), key=str)


ROWS = [(1, "a b"), (2, "a  b"), (3, "a\t\n b"), (4, None), (5, ""), (6, " "), (7, "\n"), (9, "a b"),
        (9, "a b"), (None, "a b"), (None, "only"), (None, "only"), (10, "a b"), (11, "A b"),
        (12, "x " * 50_000), (8, "x\n" * 50_000), (13, "é"), (13, "é")]


def test_exact_equals_brute_force(spark, docs_of):
    assert exact_rows(ed.exact_dedup(spark, docs_of(ROWS))) == brute_exact(ROWS)


def test_colliding_keys_are_chained(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, f"text {rng.randint(0, 40)}") for i in range(200)]
    for bits in (1, 3):
        got = ed.exact_dedup(spark, docs_of(rows), capacity=2, key_bits=bits)
        assert exact_rows(got) == brute_exact(rows)
    index = ed.build_index(spark, docs_of(rows), capacity=2, key_bits=1)
    assert index.agg({"chain": "max"}).first()[0] > 10


def test_buckets_split_when_overfull(spark, docs_of):
    rows = [(i, f"text {i}") for i in range(600)]
    index = ed.build_index(spark, docs_of(rows), capacity=50).collect()
    size = defaultdict(int)
    for r in index:
        size[r["depth"], r["bucket"]] += 1
    assert max(size.values()) <= 50 and len(size) >= 12
    for r in index:  # a bucket is the first bits of its keys
        assert r["bucket"] == (r["key"] & (1 << 64) - 1) >> (64 - r["depth"])


def test_kept_documents_keep_their_columns(spark, docs_of):
    docs = docs_of(ROWS)
    kept = ed.deduplicated(spark, docs)
    assert kept.columns == docs.columns
    want = sorted((r[0] for r in brute_exact(ROWS) if r[3]), key=str)
    # rows without any id, of equal text, are one document
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == want
    assert {(r._key, r._id, r._kept_key, r.key, r.kept) for r in kept.collect()} == {(7, "i", 8, "x", 1)}
    assert ed.exact_dedup(spark, docs_of([])).count() == 0


# ------------------------------------------------------------------ lines
def brute_lines(rows, min_chars=20, min_docs=3):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc_id is not None:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        rest = [x for x in lines if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs
                                         and doc_id != max(holders[key(x)]))]
        out.append((doc_id, len(lines), len(lines) - len(rest), "\n".join(rest)))
    return sorted(out, key=str)


def line_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()),
                  key=str)


def line_corpus():
    rng = random.Random(2)
    pool = [f"Common passage number {i} of all" for i in range(12)] + [
        "  Padded line of some length \t", "padded line of some length", "PADDED LINE OF SOME LENGTH",
        "short", "", "\r", "ÄÖÜ äöü ÄÖÜ äöü ÄÖÜ", "äöü äöü äöü äöü äöü", "x" * 19, "x" * 20, "é" * 19,
        "é" * 20, "twice only in two documents"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(80)]
    return rows + [(200, None), (201, ""), (202, "\n\n"), (7, rows[7][1]), (None, rows[8][1]),
                   (None, "x" * 20), (300, "\n".join(pool * 200)), (301, "y" * 300_000)]


def test_lines_equal_brute_force(spark, docs_of):
    rows = line_corpus()
    want = brute_lines(rows)
    assert line_rows(ld.line_dedup(spark, docs_of(rows))) == want
    assert any(r[2] for r in want)


def test_small_filters_only_cost_traffic(spark, docs_of, monkeypatch):
    rng = random.Random(3)
    rows = [(i, "\n".join(f"line {rng.randint(0, 9000)} of the long kind" for _ in range(60)))
            for i in range(300)]
    monkeypatch.setattr(ld, "BITS_PER_LINE", 0)
    assert line_rows(ld.line_dedup(spark, docs_of(rows))) == brute_lines(rows)


def test_more_segments_give_the_same(spark, docs_of, monkeypatch):
    rows = line_corpus()
    monkeypatch.setattr(ld, "BITS_PER_LINE", 1 << 14)
    packed, log2 = ld.twice_seen(spark, docs_of(rows))
    assert log2 > ld.SEGMENT_LOG2 and packed.any()
    assert line_rows(ld.line_dedup(spark, docs_of(rows))) == brute_lines(rows)


def test_no_lines(spark, docs_of):
    assert ld.line_dedup(spark, docs_of([])).count() == 0
