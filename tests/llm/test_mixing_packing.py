"""Mixing, packing and the training order."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import mixing, packing
from strata.llm import training_order as to
from strata.llm.feistel import permuted
from strata.llm.tokens import encoder, public_ranks


def brute_targets(sizes, cap=3):
    """Sources by code point, null last: share by weight, cap, share again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [
        s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, target = set(), dict.fromkeys(names, 0.0)
    total = sum(sizes.values())
    while len(full) < len(names):
        left = total - sum(cap * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w >= cap * sizes[s]]
        for s in open_:
            target[s] = left * weight[s] / w
        if not over:
            break
        full.update(over)
        for s in over:
            target[s] = cap * sizes[s]
    return target


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 12 + ["b", "c", "é", "z", None, "", "Tiny"] * 1)
        rows.append((i, " ".join(["wört"] * rng.randint(0, 60)), "en", source))
    return rows + [(9000, None, "en", "empty"), (9001, " \n", "en", "empty"),
                   (9002, "\tone  two\nthree ", "en", "tiny"), (3, rows[3][1], "en", rows[3][3]),
                   (None, "a b c", None, "hot"), (9003, "w " * 30_000, "en", "b")]


@pytest.mark.parametrize("cell_rows", [1, 16, 256])
def test_mix_meets_its_targets(spark, docs_of, cell_rows):
    rows = corpus()
    sizes, size_of = defaultdict(int), {}
    for doc_id, text, _, source in rows:
        size_of[doc_id] = len((text or "").split())
        sizes[source] += size_of[doc_id]
    got = mixing.mix(spark, docs_of(rows), cell_rows=cell_rows).collect()
    assert len(got) == len(rows)
    want, taken = brute_targets(sizes), defaultdict(int)
    for r in got:
        assert r["size"] == size_of[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["epochs"] * r["size"] + r["part"] and 0 <= r["part"] <= r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-6
        own = [r for r in got if r["source"] == source]
        assert len({r["epochs"] for r in own}) == 1     # complete epochs come first
        assert sum(0 < r["part"] < r["size"] for r in own) <= 1
    again = mixing.mix(spark, docs_of(rows).repartition(5), cell_rows=cell_rows).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_the_mix_itself(spark, docs_of):
    rows = corpus()
    docs = docs_of(rows)
    want, n = defaultdict(int), 0
    for r in mixing.mix(spark, docs).collect():
        want[r["source"]] += r["taken"]
    mixed = mixing.mixed_documents(spark, docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[r["source"]] += len(r["text"].split())
        n += 1
    assert {k: v for k, v in want.items() if v} == dict(got) and n > 100


def test_better_documents_come_first(spark, docs_of):
    from pyspark.sql import functions as F
    rows = [(i, "a b", "en", "one" if i % 2 else "two") for i in range(4000)]
    wish = spark.createDataFrame([("one", 1.0), ("two", 3.0)], "source string, weight double")
    got = mixing.mix(spark, docs_of(rows), weights=wish,
                     weight=F.when(F.col("doc_id") % 4 == 1, 4.0).otherwise(1.0)).collect()
    one = [r for r in got if r["source"] == "one"]
    good = sum(r["taken"] for r in one if r["doc_id"] % 4 == 1)
    assert good > 0.65 * sum(r["taken"] for r in one)


def test_mix_of_nothing(spark, docs_of):
    assert mixing.mix(spark, docs_of([])).count() == 0
    assert mixing.mix(spark, docs_of([(1, None), (2, "")])).agg({"taken": "sum"}).first()[0] == 0


# ------------------------------------------------------------------ tokens
ODD = ["", " ", "a", " a", "a ", "a  b", "a\nb", "\n", "a \n b", "it's I'd 'tis", "x y   z",
       "über 12,5% (Straße)", "<|endoftext|> now", "日本語 テキスト", "a\tb c", "  x", "é" * 50,
       "1 2 3 4", "word " * 3000, "z" * 20_000, "a b\x1cc d", "  lead", "trail  ", "no_space" * 10]


def test_ids_are_those_of_the_tokenizers_file():
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer
    known = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    known.encode_special_tokens = True
    import pyarrow.parquet as pq
    texts = ODD + pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    ids, at = encoder(public_ranks()).ids(pa.array([*texts, None], pa.string()), 1)
    sizes = encoder(public_ranks()).lengths(pa.array([*texts, None], pa.string()))
    for i, text in enumerate([*texts, ""]):
        want = known.encode(text, add_special_tokens=False).ids
        assert ids[at[i]:at[i + 1]].tolist() == [*want, 1], repr(text[:60])
        assert sizes[i] == len(want)


def brute_cost(pos, penalty, chosen, seq_len):
    of = dict(zip(pos, penalty, strict=True))
    return sum(seq_len - (b - a) + of[b] for a, b in zip(chosen, chosen[1:], strict=False))


def test_cuts_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(200):
        seq_len = rng.randint(4, 12)
        pos, penalty = [0], [0]
        while pos[-1] < 40:
            pos.append(pos[-1] + rng.randint(1, seq_len))
            penalty.append(rng.choice([0, 3, 9]))
        best = {0: 0}
        for j in range(1, len(pos)):
            best[j] = min(best[i] + seq_len - (pos[j] - pos[i]) + penalty[j]
                          for i in range(j) if pos[j] - pos[i] <= seq_len)
        near = [j for j in range(len(pos)) if pos[j] >= pos[-1] - seq_len]
        chosen = packing.cuts(pos, penalty, seq_len, last=False)
        assert brute_cost(pos, penalty, chosen, seq_len) == min(best[j] for j in near)
        whole = packing.cuts(pos, penalty, seq_len, last=True)
        assert whole[0] == 0 and whole[-1] == pos[-1]
        assert all(0 < b - a <= seq_len for a, b in zip(whole, whole[1:], strict=False))


@pytest.mark.parametrize("seq_len,block", [(16, 40), (64, 500), (2048, 1 << 20)])
def test_packing_is_an_exact_round_trip(spark, docs_of, seq_len, block):
    rng = random.Random(7)
    texts = [None, *ODD] + [" ".join(rng.choices(["the", "end.", "of", "lines\n", "Straße"],
                                                 k=rng.randint(0, 300))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    pieces = packing.pack(docs_of(rows), seq_len=seq_len, block=block, with_ids=True).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] > 0 and zlib.crc32(bytes(p["ids"])) == p["ids_crc32"]
        assert len(p["ids"]) == 4 * p["length"]
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    enc = encoder(public_ranks())
    for i, text in rows:
        own = sorted(by_doc[i], key=lambda p: p["start"])
        ids = [*enc.encode(text or "").tolist(), 1]
        assert b"".join(bytes(p["ids"]) for p in own) == np.array(ids, "<u4").tobytes()
        place = 0
        for p in own:
            assert p["start"] == place and p["doc_tokens"] == len(ids)
            place += p["length"]
    padding = total = 0
    for own in by_seq.values():
        own.sort(key=lambda p: p["offset"])
        place = 0
        for p in own:
            assert p["offset"] == place
            place += p["length"]
        assert place <= seq_len
        total += place
        padding += 0 if place & (place - 1) == 0 else seq_len - place
    if seq_len > 16:
        assert padding < 0.06 * total
    assert packing.pack(docs_of([])).count() == 0
    twice = packing.pack(docs_of([(1, "a b"), (1, "a b"), (None, "a b")])).collect()
    assert sum(p["length"] for p in twice) == 9


# ------------------------------------------------------------------ order
def test_permutation():
    for n in (1, 2, 3, 17, 64, 1000, 4097):
        p = permuted(np.arange(n), n, "k")
        assert sorted(p.tolist()) == list(range(n))
    a, b = permuted(np.arange(1000), 1000, "k"), permuted(np.arange(1000), 1000, "l")
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9
    assert abs(np.corrcoef(a, np.arange(1000))[0, 1]) < 0.15


def test_shards_hold_every_sequence_once(spark, docs_of, tmp_root):
    rng = random.Random(8)
    texts = [None, *ODD] + [" ".join(rng.choices(["the", "end.", "of"], k=rng.randint(0, 90)))
                            for _ in range(40)]
    docs_of(list(enumerate(texts))).write.parquet(f"{tmp_root}/docs")
    docs = spark.read.parquet(f"{tmp_root}/docs")
    shards = to.materialise(spark, docs, seq_len=32, shard_len=16)
    rows = to.read(spark, shards).collect()
    assert sorted(r["slot"] for r in rows) == list(range(shards.n)) and shards.n > 50
    enc = encoder(public_ranks())
    full = {i: [*enc.encode(t or "").tolist(), to.END] for i, t in enumerate(texts)}
    assert sum(r["n_tokens"] for r in rows) == sum(map(len, full.values()))
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u2").tolist()
        head = full[r["doc_id"]][r["start"]:r["start"] + 32]
        assert ids[:len(head)] == head and len(ids) == r["n_tokens"]
        assert (r["shard"], r["byte"]) == shards.place(r["slot"])
    later = to.read(spark, shards, first=37).collect()
    assert sorted(r["slot"] for r in later) == list(range(37, shards.n))
    # the file itself: fixed stride, readable at any slot
    from pyspark.sql import functions as F
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(shards.path)
             .select("shard", "content", F.length("content").alias("n")).collect())
    assert sorted(f["shard"] for f in files) == list(range(-(-shards.n // 16)))
    slot = 21
    shard, byte = shards.place(slot)
    content = next(f["content"] for f in files if f["shard"] == shard)
    record = np.frombuffer(bytes(content[byte:byte + shards.stride]), to.record_type(32))[0]
    want = next(r for r in rows if r["slot"] == slot)
    assert record["n"] == want["n_tokens"] and record["start"] == want["start"]


def test_order_of_nothing(spark, docs_of, tmp_root):
    docs_of([]).write.parquet(f"{tmp_root}/none")
    shards = to.materialise(spark, spark.read.parquet(f"{tmp_root}/none"))
    assert shards.n == 0 and to.read(spark, shards).count() == 0
