"""The pipeline, stage by stage, against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as cp
from strata.llm.tokens import encoder, public_ranks

from test_mixing_packing import brute_targets
from test_near_dedup import brute, edited
from test_search_scan_language import DE, EN, FR, sentences

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(21)
    rows = []
    for i in range(120):
        lang, text = (("en", EN), ("de", DE), ("fr", FR))[i % 3]
        words = [f"{w}{rng.choice(['', 'er', 'ing', 'ly'])}" for w in sentences(rng, text, 80).split()]
        rows.append((i, " ".join(words), lang, f"s{i % 4}"))
    copies = []
    for i in range(0, 120, 4):
        copies.append((1000 + i, rows[i][1].replace(" ", "  ", 3), rows[i][2], "copied"))
        copies.append((2000 + i, " ".join(edited(rng, rows[i][1].split(), 0.02)), rows[i][2], None))
    return rows + copies + [(5000, None, "en", "s1"), (5001, "", None, "s1"), (5002, "12 -- 34", "en", "s1"),
                            (0, rows[0][1], "en", "s0"), (None, EN, "en", "s2")]


def test_stages(spark, docs_of, tmp_root):
    rows = corpus()
    (docs_of(rows).select(*COLUMNS).write.parquet(f"{tmp_root}/documents.parquet"))
    docs, kept = spark.read.parquet(f"{tmp_root}/documents.parquet"), []
    for k, (_, step) in enumerate(cp.STAGES):
        step(spark, docs, tmp_root).write.parquet(f"{tmp_root}/{k}")
        docs = spark.read.parquet(f"{tmp_root}/{k}")
        if k < len(cp.STAGES) - 1:
            assert docs.columns == COLUMNS
        kept.append(docs.collect())
    spoken, exact, near, mixed, packed = kept

    def ids(found):
        return sorted((r["doc_id"] for r in found), key=str)

    silent = {5000, 5001, 5002}
    assert ids(spoken) == sorted((r[0] for r in rows if r[0] not in silent), key=str)

    first = {}
    for r in sorted(spoken, key=lambda r: (r["doc_id"] is None, r["doc_id"])):
        first.setdefault(re.sub("[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert ids(exact) == sorted(first.values(), key=str)

    known = [(r["doc_id"], r["text"]) for r in exact if r["doc_id"] is not None]
    stay = [i for i, (_, component) in brute(known).items() if i == component]
    assert ids(near) == sorted([*stay, None], key=str)
    assert {r["text"] for r in near} <= {r[1] for r in rows}

    sizes = defaultdict(int)
    for r in near:
        sizes[r["source"]] += len(r["text"].split())
    taken = defaultdict(int)
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    for source, target in brute_targets(sizes).items():
        assert taken[source] == pytest.approx(target, abs=0.51)
    whole = {r["doc_id"]: r["text"] for r in near}
    for r in mixed:
        assert whole[r["doc_id"]].split()[:len(r["text"].split())] == r["text"].split()

    enc, tokens, got = encoder(public_ranks()), Counter(), Counter()
    for r in mixed:
        tokens.update([*enc.encode(r["text"]).tolist(), 1])
    places = defaultdict(list)
    for p in packed:
        got.update(np.frombuffer(bytes(p["ids"]), "<u4").tolist())
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    assert got == tokens
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))
        assert sum(n for _, n in own) <= 2048


def test_run_and_registration(spark):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is cp.run and "pipeline" not in entry.oracle_sql()
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and {"doc_id", "ids", "sequence_id", "offset"} <= set(out.columns)


def test_empty_corpus(spark, docs_of, tmp_root):
    docs_of([]).select(*COLUMNS).write.parquet(f"{tmp_root}/documents.parquet")
    assert cp.run(spark, tmp_root).count() == 0


@pytest.mark.parametrize("held_out_label", [False, True])
def test_corpus_without_a_label_to_learn_from(spark, docs_of, tmp_root, held_out_label):
    """No label at all, or one that is kept apart from fitting (crc32 of the id)."""
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    rows = [(i, " ".join(f"w{i}ord{k}" for k in range(40)), "en" if held_out_label and i == held else None)
            for i in range(30)] + [(40, None, None), (41, "", None), (42, "12 -- 34", None), (43, "日本", None)]
    docs = docs_of(rows)
    kept = cp.language(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(30), 43]
    docs.select(*COLUMNS).write.parquet(f"{tmp_root}/documents.parquet")
    assert len({r["doc_id"] for r in cp.run(spark, tmp_root).collect()}) > 20
