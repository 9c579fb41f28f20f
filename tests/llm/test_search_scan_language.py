"""Top-k search, license scan, language identification."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import language_id as lid
from strata.llm import license_scan as ls
from strata.llm import topk_search as tk

NAN, INF = float("nan"), float("inf")


def brute_top(rows, k=10, divisor=100):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q in sorted({i for i, _ in usable if i % divisor == 0}):
        v = min(v for i, v in usable if i == q)
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable
                  if i != q and len(w) == len(v)]
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out[q, rank] = (i, -s)
    return out


def vectors(n=900, d=8, seed=9):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=d).round(3).tolist()) for i in range(n)]
    hot = rng.normal(size=d).round(3).tolist()
    rows += [(2000 + i, hot) for i in range(300)]            # ties by the hundred
    rows += [(5000, None), (5100, [None] * d), (5200, [NAN] + [1.0] * (d - 1)), (5300, [INF] * d),
             (None, hot), (5400, hot[:3]), (5401, hot[:3]), (5500, []), (5501, []), (5600, [0.0] * d),
             (2000, hot), (300, [0.5] * d), (1, hot)]
    return rows


@pytest.mark.parametrize("shard_rows,block", [(64, 700), (1 << 13, 32 << 20)])
def test_top_k_equals_brute_force(spark, shard_rows, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumnsRenamed({}) \
        .selectExpr("*", "'x' as score", "1 as v", "2 as wave", "3 as n").repartition(4)
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
              for i, v in rows]
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"])
           for r in tk.exact_top_k(spark, df, shard_rows=shard_rows, block_bytes=block).collect()}
    assert got == brute_top(rows32)
    assert tk.exact_top_k(spark, df.limit(0)).count() == 0


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-3e5, 3e5) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"])
           for r in tk.exact_top_k(spark, df).collect()}
    assert got == brute_top(rows)


def test_search_opens_few_leaves():
    """Clustered vectors: most of the tree is never scored."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 4000
    rows = (centres[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 16)) * 40).astype(np.int64)

    class Counted(np.ndarray):
        seen = 0

        def __matmul__(self, other):
            Counted.seen += len(self)
            return np.asarray(self) @ np.asarray(other)

    tree = tk.build(rows, np.arange(8000))
    tree.vectors = rows[tree.ids].view(Counted)
    floor = np.tile([np.iinfo(np.int64).min, np.iinfo(np.int64).max], (20, 1))
    got = list(tk.search(tree, rows[:20], np.arange(20), floor, 10, False))
    for i in range(20):
        own = sorted(s for j, _, s in got if j == i)
        want = np.sort(np.delete(rows @ rows[i], i))[-10:]
        assert own == want.tolist()
    assert Counted.seen < 0.35 * 20 * 8000


# ------------------------------------------------------------------ licenses
def found(spark, docs_of, rows, **kw):
    return {r["doc_id"]: [(m["template"], round(m["coverage"], 3), m["start"], m["end"]) for m in r["matches"]]
            for r in ls.license_scan(spark, docs_of(rows), **kw).collect()}


def test_notices_are_found_with_their_spans(spark, docs_of):
    notice = "Released under the MIT License."
    rows = [(1, f"é wörd the end.\n{notice}"), (2, f"{notice} more {notice}"), (3, "released\tunder  THE mit (license)"),
            (4, "the MIT way is released under license"), (5, None), (6, ""), (7, "x " * 40_000 + notice),
            (8, "Released under the\n\n--- --- MIT License."), (9, "All rights reserved."),
            (10, "all rights"), (11, "Released under the Expat License.")]
    got = found(spark, docs_of, rows)
    at = len("é wörd the end.\n")
    assert got[1] == [("MIT-notice", 1.0, at, at + len(notice))]
    assert got[2] == [("MIT-notice", 1.0, 0, 31), ("MIT-notice", 1.0, 37, 68)]
    assert got[3] == [("MIT-notice", 1.0, 0, 33)]
    assert got[4] == got[5] == got[6] == got[10] == []
    assert got[7] == [("MIT-notice", 1.0, 80_000, 80_031)]
    assert got[8] == [("MIT-notice", 1.0, 0, len(rows[7][1]))]
    assert got[9] == [("All-rights-reserved", 1.0, 0, 20)]
    assert got[11] == [("MIT-notice", 0.8, 0, 33)]
    assert ls.license_scan(spark, docs_of([])).count() == 0


def test_changed_texts_align_within_the_band(spark, docs_of):
    name, text = next(t for t in ls.TEMPLATES if t[0] == "MIT-grant")
    words = text.split()
    changed = words[:10] + ["NEW", "WORDS"] + words[10:30] + words[33:]
    half = words[:len(words) // 2]
    got = found(spark, docs_of, [(1, "a b c " + " ".join(changed) + " d e"), (2, " ".join(half)),
                                 (3, " ".join(reversed(words)))])
    assert [(m[0], m[1]) for m in got[1]] == [(name, round((len(words) - 3) / len(words), 3))]
    assert got[1][0][2] == 6
    assert got[2] == got[3] == []


def test_alignment_equals_plain_dynamic_programming():
    rng = random.Random(3)

    def plain(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + (x == y))
        return best[-1][-1]
    for _ in range(200):
        a = [rng.randint(0, 5) for _ in range(rng.randint(1, 12))]
        b = [rng.randint(0, 5) for _ in range(rng.randint(1, 14))]
        template = ls.Template(np.array(a), 0.5)
        place = [j for j, w in enumerate(b) if w in a]
        own, whole = [b[j] for j in place], [(-1, -1)] * len(place)
        most = max(plain(a, b[i:i + template.width]) for i in range(len(b)))
        if not most:
            continue
        # with all places in the band, and within the bands around the fingerprints
        for bands in (whole, template.bands(place, own)):
            best = [n for n in range(1, len(a) + 1)
                    if template.aligned(place, own, bands, 0, len(own), n) is not None]
            if bands is whole or most >= template.need:
                assert max(best, default=0) == most
                first, last = template.aligned(place, own, bands, 0, len(own), most)
                assert plain(a, b[place[first]:place[last] + 1]) == most


def test_own_templates(spark, docs_of):
    mine = spark.createDataFrame([("T", "alpha beta gamma delta")], "template string, text string")
    assert found(spark, docs_of, [(1, "x alpha beta gamma delta y")], templates=mine)[1] == [("T", 1.0, 2, 24)]


def test_winnowing_keeps_a_key_of_every_window():
    rng = np.random.default_rng(1)
    for window in (1, 2, 5, 40, 1000):
        keys = rng.integers(0, 50, 400).astype(np.uint64)
        kept = set(ls.winnowed(keys, window).tolist())
        w = min(window, len(keys))
        for i in range(len(keys) - w + 1):
            assert any(j in kept and keys[j] == keys[i:i + w].min() for j in range(i, i + w))


def test_more_fingerprints_than_words_that_may_be_missing():
    for coverage in (0.5, 0.8, 1.0):
        index = ls.Index(ls.TEMPLATES, coverage)
        for t, template in enumerate(index.templates):
            places = [i for own in template.prints.values() for i in own]
            assert len(places) > len(template.words) - template.need
            of, number = index.hits(template.words)
            assert sorted(number[of == t].tolist()) == [
                i for i, w in enumerate(template.words.tolist()) if w in template.prints]


def test_every_variant_at_the_coverage_is_found(spark, docs_of):
    """Each choice of words that may be changed or left out, of each short
    template, alone and next to another occurrence."""
    rows, expected = [], []
    for name, text in ls.TEMPLATES:
        words = text.split()
        spare = len(words) - int(np.ceil(ls.COVERAGE * len(words)))
        choices = list(itertools.combinations(range(len(words)), spare)) if len(words) <= 16 else \
            [range(k, len(words), 5)[:spare] for k in range(5)]
        for gone in choices:
            changed = " ".join("Foo" if i in gone else w for i, w in enumerate(words))
            fewer = " ".join(w for i, w in enumerate(words) if i not in gone)
            rows += [(len(rows), f"aa {changed} zz"), (len(rows) + 1, fewer),
                     (len(rows) + 2, f"{fewer} {fewer} {text} {text}")]
            expected += [(name, 1), (name, 1), (name, 4)]
    got = found(spark, docs_of, rows)
    for (i, text), (name, n) in zip(rows, expected, strict=True):
        own = [m for m in got[i] if m[0] == name]
        assert len(own) == n, (name, text)
        assert all(a[3] <= b[2] for a, b in zip(own, own[1:], strict=False)), (name, text)
        if n == 4:
            assert [m[1] for m in own[2:]] == [1.0, 1.0] and own[3][3] == len(text)


def test_occurrences_equal_brute_force():
    """Number and coverage against common subsequences of all stretches."""
    rng = random.Random(8)

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j + 1], new[j], row[j] + (x == y)))
            row = new
        return row[-1]
    seen = 0
    for _ in range(300):
        words = [rng.randint(0, 5) for _ in range(rng.randint(3, 7))]
        template = ls.Template(np.array(words), 0.8)
        text = []
        for _ in range(rng.randint(1, 4)):
            text += [w if rng.random() < 0.9 else rng.randint(0, 12) for w in words if rng.random() < 0.95]
            text += [rng.randint(0, 40) for _ in range(rng.randint(0, 4))]
        own = [j for j, w in enumerate(text) if w in words]
        got = template.occurrences(own, [text[j] for j in own])
        stretches = {(a, b): common(words, text[a:b]) for a in range(len(text))
                     for b in range(a + 1, min(len(text), a + template.width) + 1)}
        most = [0] * (len(text) + 1)
        for b in range(1, len(text) + 1):
            most[b] = max([most[b - 1]] + [most[a] + 1 for a in range(b)
                                           if stretches.get((a, b), 0) >= template.need])
        assert len(got) == most[-1]
        edges = [-1, *[x for n, a, b in got for x in (a, b)], len(text)]
        for k, (n, a, b) in enumerate(got):
            assert edges[2 * k] < a <= b < edges[2 * k + 3]
            assert stretches[a, b + 1] == n >= template.need
        seen += len(got)
    assert seen > 300


# ------------------------------------------------------------------ languages
EN = "the quick brown fox jumps over the lazy dog and then it runs with the other dogs to the house"
DE = "der schnelle braune fuchs springt über den faulen hund und dann läuft er mit den anderen zum haus"
FR = "le rapide renard brun saute par dessus le chien paresseux et ensuite il court vers la maison"


def sentences(rng, text, n):
    return " ".join(rng.choices(text.split(), k=n))


def labelled(seed=5, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, text = (("en", EN), ("de", DE), ("fr", FR))[i % 3]
        rows.append((i, sentences(rng, text, 40), lang))
    return rows


def test_languages_and_mixtures(spark, docs_of):
    rng = random.Random(6)
    rows = labelled() + [
        (1000, None, "en"), (1001, "", "en"), (1002, "12 34 -- !?", "en"),
        (1003, sentences(rng, EN, 70) + " " + sentences(rng, FR, 30), None),
        (1004, sentences(rng, DE, 50_000), None), (1005, "日本", None), (1006, sentences(rng, DE, 3), "en"),
        (None, sentences(rng, FR, 40), None), (3, sentences(rng, EN, 40), "de")]
    got = {r["doc_id"]: r for r in lid.language_id(spark, docs_of(rows)).collect()}
    for i, _, lang in rows[:150]:
        if i != 3:
            assert got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1
            assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["langs"]) == ("und", 0.0, [])
    assert got[1003]["langs"][:2] == ["en", "fr"] and 0.55 < got[1003]["score"] < 0.85
    assert sum(got[1003]["shares"]) == pytest.approx(1)
    assert got[1004]["lang_pred"] == "de" and got[1005]["lang_pred"] in ("en", "de", "fr")
    assert got[None]["lang_pred"] == "fr"
    single = [r for i, r in got.items() if i is not None and i < 150]
    assert sum(len(r["langs"]) == 1 for r in single) > 0.9 * len(single)


def test_no_labels_and_no_rows(spark, docs_of):
    got = lid.language_id(spark, docs_of([(1, "hello there", None)])).collect()
    assert got[0]["lang_pred"] == "und"
    assert lid.language_id(spark, docs_of([])).count() == 0
    docs = docs_of([*labelled(), (900, "12", "en")])
    kept = lid.spoken(spark, docs)
    assert kept.columns == docs.columns and kept.count() == 150
    assert {(r._language, r.language) for r in kept.collect()} == {("none", 2)}


def test_a_text_that_fills_a_language_is_learned_once(spark, docs_of):
    """Nine in ten English rows are copies of one text: the model is that of the distinct texts."""
    rng = random.Random(12)
    rows = [(i, sentences(rng, text, 30), lang) for i, (lang, text) in
            enumerate([("en", EN), ("de", DE), ("fr", FR)] * 40)]
    copies = [(1000 + i, rows[0][1], "en") for i in range(360)]
    one, many = (lid.fit(spark, docs_of(r), sample_docs=30) for r in (rows, rows + copies))
    assert one.languages == many.languages == ["de", "en", "fr"]
    assert (one.logp == many.logp).all()


def test_estimation_follows_the_definition():
    """The vectorised steps against plain loops, for one document."""
    rng = np.random.default_rng(2)
    r = rng.uniform(0.01, 1, (30, 3))
    share = np.array([0.5, 0.3, 0.2])
    for _ in range(lid.STEPS):
        p = np.array([[r[i, k] * share[k] for k in range(3)] for i in range(30)])
        share = (p / p.sum(axis=1, keepdims=True)).sum(axis=0) / 30
    got, log = lid._estimate(r, np.zeros(30, int), np.array([0]), np.array([30]), np.array([[0.5, 0.3, 0.2]]))
    assert got[0] == pytest.approx(share)
    assert log[0] == pytest.approx(sum(np.log((r[i] * share).sum()) for i in range(30)))


def test_held_out_accuracy(spark):
    from strata.llm.queries import op2_language_id
    got = {r["doc_id"]: r for r in op2_language_id(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    held = [d for d in docs if got[d["doc_id"]]["held_out"] and d["lang"]]
    assert len(got) == len(docs) and len(held) > 100
    assert sum(got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held) >= 0.97 * len(held)


def test_models_of_a_slice_equal_those_of_a_whole():
    model = lid.Model(["a", "b"], np.log(np.random.default_rng(1).dirichlet([1] * lid.BUCKETS, 2)).T.astype(np.float32))
    texts = pa.array([EN, DE, None, "", FR])
    whole = lid.predict(texts, model).to_pylist()
    assert whole == [lid.predict(texts.slice(i, 1), model).to_pylist()[0] for i in range(5)]


def test_all_languages_of_a_document_are_selected():
    """Seven languages that share no trigram, as many words of each, and a set
    that is no prefix of the order of votes."""
    names = "abcdefg"
    words = {x: [x + y + x for y in "hijklmnopqrstuv"] for x in names}
    counts = np.full((lid.BUCKETS, 7), lid.SMOOTHING)
    for k, x in enumerate(names):
        bucket, _ = lid._trigrams([w.encode() for w in words[x]])
        np.add.at(counts[:, k], bucket, 100)
    model = lid.Model(list(names), np.log(counts / counts.sum(axis=0)).astype(np.float32))
    rng = random.Random(3)
    text = [w for k, x in enumerate(names) for w in rng.choices(words[x], k=100 + 20 * k)]
    got = lid.predict(pa.array([" ".join(text)]), model).to_pylist()[0]
    assert got["langs"] == list("gfedcba") and got["lang"] == "g"
    assert got["shares"] == pytest.approx([(220 - 20 * k) / 1120 for k in range(7)], abs=0.01)


def test_sets_grow_as_by_plain_loops():
    """The penalised likelihood of the set against greedy growth with plain
    estimation to convergence."""
    rng = np.random.default_rng(7)
    sets = set()
    for _ in range(40):
        n, n_lang = int(rng.integers(5, 120)), 6
        own = rng.integers(0, n_lang, rng.integers(1, 5))
        log = rng.normal(-4, 2, (n, n_lang))
        log[np.arange(n), rng.choice(own, n)] += 6
        table = np.exp(np.maximum(log - log.max(axis=1, keepdims=True), -30)).astype(np.float32)
        times = rng.integers(1, 4, n).astype(float)
        total = times.sum()

        def fitted(some, table=table, times=times, total=total):
            r = table[:, some].astype(float)
            share = np.full(len(some), 1 / len(some))
            for _ in range(5000):
                p = r * share
                share = (p / p.sum(axis=1, keepdims=True) * times[:, None]).sum(axis=0) / total
            return (times * np.log((r * share).sum(axis=1))).sum() - (len(some) - 1) * (lid.PENALTY + np.log(total))
        some, value = [], -np.inf
        while len(some) < n_lang:
            best, new = max((fitted([*some, k]), k) for k in range(n_lang) if k not in some)
            if best <= value:
                break
            some, value = [*some, new], best
        _, got, share = lid._grown(table, np.arange(n), times, np.array([0]), np.array([total]))
        assert fitted(got[0].tolist()) == pytest.approx(value, abs=0.02)
        assert share[0].sum() == pytest.approx(1) and (share[0] > 0).all()
        sets.add(len(some))
    assert len(sets) > 2
