"""Near duplicates against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import minhash_dedup as mh
from strata.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOWER).replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                label[root(i)] = root(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        lowest[root(i)] = min(lowest.get(root(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), lowest[root(i)]) for i, (doc_id, _) in enumerate(rows)}


def edited(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else [w, f"n{rng.randint(0, 999)}"] if x < 2 * share / 3 else \
            [f"r{rng.randint(0, 999)}"] if x < share else [w]
    return out


def corpus(seed=11):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n\t", "One", "one", "one two", "ONE  two", "one two three four",
             "one two three four five", "one two three four five", "É a b c d", "é a b c d"]
    for _ in range(25):
        words = rng.choices(vocabulary, k=rng.randint(20, 300))
        texts.append(" ".join(words))
        for share in (0.01, 0.03, 0.05, 0.06, 0.08, 0.15):
            texts.append(" ".join(edited(rng, words, share)))
    # a group whose members are near its hub and each other in chains
    words = rng.choices(vocabulary, k=200)
    for _ in range(120):
        texts.append(" ".join(edited(rng, words, rng.choice([0.0, 0.02, 0.05, 0.07]))))
        if rng.random() < 0.1:
            words = edited(rng, words, 0.05)
    # many copies, and a passage that many share
    texts += [texts[20]] * 40 + [" ".join(rng.choices(vocabulary, k=60) + words[:40]) for _ in range(40)]
    texts.append(" ".join(rng.choices(vocabulary, k=30_000)))
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i * 3, t) for i, t in zip(order, texts, strict=True)]


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("hubs", [0, 2])
def test_components_equal_brute_force(spark, docs_of, monkeypatch, hubs):
    """With no hub rounds, the chunked comparison alone finds every link."""
    monkeypatch.setattr(mh, "HUB_ROUNDS", hubs)
    monkeypatch.setattr(mh, "CHUNK", 16)
    rows = corpus()
    df = mh.near_duplicates(spark, docs_of(rows))
    assert result(df) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in df.collect())


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    for share in (0.3, 0.75, 0.95):
        common = int(2 * share / (1 + share) * 3000)
        other = np.concatenate([base[:common], rng.integers(0, 1 << 62, 3000 - common).astype(np.uint64)])
        low = [mh.mixed(mh.minima(np.unique(x))) & np.uint64(15) for x in (base, other)]
        assert abs(mh.similarity((low[0] == low[1]).sum()) - share) < 0.16


def test_sets_of_whole_texts():
    texts = ["a b c d e f", "A  B\tc\nd e f ", "a b c d", None, "", "a b c d e f a b c d e f"]
    sets = mh.shingle_sets(pa.array(texts, pa.string()))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[0] == sets[1]).all()


def test_missing_and_repeated_ids(spark, docs_of):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "only this one here now"),
            (None, None), (7, None)]
    got = sorted((tuple(r) for r in mh.near_duplicates(spark, docs_of(rows)).collect()), key=str)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 1, None, True),
                          (None, 0, None, True), (7, 0, 7, True)], key=str)
    assert mh.near_duplicates(spark, docs_of([])).count() == 0
    docs = docs_of(rows)
    kept = mh.without_near_duplicates(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r._gone, r._key) for r in kept.collect()), key=str) == sorted(
        [(5, "a b c d e f", None, 7), (None, "only this one here now", None, 7), (None, None, None, 7),
         (7, None, None, 7)], key=str)


def test_links_of_an_id_with_several_texts(spark, docs_of):
    """A doc_id with two texts is one node; rows without an id keep one of their class."""
    rng = random.Random(2)
    a, b, c = (rng.choices([f"w{i}" for i in range(999)], k=90) for _ in range(3))
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, " ".join(edited(rng, a, 0.01))),
            (9, " ".join(edited(rng, b, 0.01))), (None, " ".join(edited(rng, b, 0.01))),
            (None, " ".join(c)), (None, " ".join(c)), (None, " ".join(edited(rng, c, 0.01)))]
    got = [(r.doc_id, r.component_id) for r in mh.near_duplicates(spark, docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted([(5, 5), (5, 5), (7, 5), (9, 5), (None, 5)] + [(None, None)] * 3, key=str)
    kept = mh.without_near_duplicates(spark, docs_of(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 5), (True, None)]
    assert {r.text for r in kept} <= {t for _, t in rows}


def test_rows_grow_with_the_members_of_a_group(spark, docs_of, monkeypatch):
    """Copies of one text at the threshold: what is shuffled and confirmed grows
    in proportion to the group, not with its pairs."""
    counted = {}
    write = mh.stage

    def counting(session, df, name, *by):
        out = write(session, df, name, *by)
        counted[name] = counted.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(mh, "stage", counting)
    steps = {}
    for n in (200, 400, 800):
        rng = random.Random(n)
        words = rng.choices([f"w{i}" for i in range(3000)], k=200)
        rows = [(i, " ".join(edited(rng, words, 0.033))) for i in range(n)]
        counted.clear()
        mh.near_duplicates(spark, docs_of(rows)).count()
        steps[n] = {k: v for k, v in counted.items() if not k.endswith("labels")}
    for n, rows in steps.items():
        assert rows["op8-met0"] <= n and rows["op8-hub0"] <= n
        assert rows["op8-open"] <= 32 * n and rows["op8-suspects"] <= 2 * rows["op8-open"]
        assert rows["op8-joining"] < max(1, rows["op8-suspects"])
        assert sum(rows.values()) < 200 * n


def test_long_chains_of_links(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(1, 50)]
    random.Random(1).shuffle(links)
    got = components(spark, spark.createDataFrame(links, "a bigint, b bigint"), "test").collect()
    assert {r["node"]: r["label"] for r in got} == {
        **{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(50)}}
