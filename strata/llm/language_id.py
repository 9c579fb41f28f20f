"""Language identification as a mixture of languages.

Each language has a model of byte trigrams of words, fitted on a bounded sample
of labelled documents.  A document's words are explained by a mixture of the
languages: expectation-maximisation over the trigram likelihoods of the words
estimates the proportions.  The set grows from the most likely language: the one
that raises the likelihood most is added as long as it outweighs a penalty for a
further language.  The prediction is the language with the largest proportion,
which is also its score.

Distinct words of a batch are scored once, and the steps of the estimation run
over all documents of a slice together that are not settled.  The likelihood is
concave in the proportions, so its slope bounds what more steps, or a further
language, can gain; what cannot outweigh the penalty is not tried further.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import U64, slices, words

SAMPLE_DOCS = 3000       # labelled documents of a language that a model is fitted on, at most
MAX_LANGUAGES = 1000     # bounds the model that is broadcast; more is an error
BUCKETS = 1 << 15        # of hashed trigrams
SMOOTHING = 0.1
TEMPER = 0.5             # the trigrams of a word overlap
STEPS = 8                # of estimation between two tests of convergence
TOLERANCE = 0.01         # of a log-likelihood, below its maximum
PENALTY = 3.0            # of a further language, and once more the log of the words
UNKNOWN = "und"
SLICE = 2 << 20

RESULT = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("langs", T.ArrayType(T.StringType())),
    T.StructField("shares", T.ArrayType(T.DoubleType()))])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logp: np.ndarray     # (trigram bucket, language)


def _letters(found: list[bytes]) -> list[bytes]:
    """Each word in lower case, without what is not a letter."""
    out = []
    for word in found:
        s = word.decode("utf-8", "replace").lower()
        out.append((s if s.isalpha() else "".join(filter(str.isalpha, s))).encode())
    return out


def _trigrams(letters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of the words (none empty), with a mark at both
    ends, and the first of each word."""
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in letters), np.uint8).astype(U64)
    size = np.fromiter(map(len, letters), np.int64, len(letters)) + 2
    ends = np.cumsum(size)
    valid = np.ones(len(raw), bool)
    valid[ends - 1] = valid[ends - 2] = False
    code = raw[:-2] << U64(16) | raw[1:-1] << U64(8) | raw[2:]
    with np.errstate(over="ignore"):
        bucket = (code * U64(0x9E3779B97F4A7C15) >> U64(40)) & U64(BUCKETS - 1)
    return bucket[valid[:-2]].astype(np.int64), np.concatenate([[0], np.cumsum(size - 2)[:-1]])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in set(langs.tolist()):
            rows = pa.array(np.flatnonzero(langs == lang))
            found, index, _ = words(batch.column("text").take(rows))
            letters = _letters(found)
            n = np.bincount(index, minlength=len(found))
            own = [i for i, w in enumerate(letters) if w]
            if own:
                bucket, starts = _trigrams([letters[i] for i in own])
                weight = np.repeat(n[own], np.diff(starts, append=len(bucket)))
                total[lang] = total.get(lang, 0) + np.bincount(bucket, weight, BUCKETS)
    for lang, counts in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([counts.astype("<f8").tobytes()], pa.binary())],
            ["lang", "counts"])


def fit(spark: SparkSession, labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of the languages of ``labelled`` (text, lang).  Rows without one
    of the two are left out.  At most ``sample_docs`` documents of a language,
    those with the smallest hash of their text, are used, each text once; what
    the driver gathers is a table of trigrams per language."""
    own = labelled.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    own = own.withColumn("h", F.xxhash64("text"))
    sizes = own.groupBy("lang").agg(F.count_distinct("h").alias("texts")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    share = spark.createDataFrame([(r["lang"], min(1.0, 2.0 * sample_docs / r["texts"])) for r in sizes],
                                  "lang string, share double")
    first = Window.partitionBy("lang").orderBy("h")
    sample = (own.join(F.broadcast(share), "lang")  # a row per language
              .where(F.shiftrightunsigned("h", 11) / float(1 << 53) < F.col("share"))
              .dropDuplicates(["lang", "h"])
              .withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample_docs))
    counts: dict[str, np.ndarray] = {r["lang"]: np.zeros(BUCKETS) for r in sizes}
    for row in sample.select("text", "lang").mapInArrow(_counted, "lang string, counts binary").collect():
        counts[row["lang"]] += np.frombuffer(row["counts"], "<f8")
    languages = sorted(counts)
    table = np.stack([counts[x] for x in languages], axis=1) + SMOOTHING
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def _likelihoods(found: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per distinct word, whether it has a letter, and its likelihood in each
    language relative to the best."""
    letters = _letters(found)
    has = np.fromiter(map(bool, letters), bool, len(letters))
    out = np.ones((len(found), len(model.languages)), np.float32)
    own = np.flatnonzero(has)
    step = max(1, 2_000_000 // max(1, len(model.languages)))
    for at in range(0, len(own), step // 8 + 1):
        run = own[at:at + step // 8 + 1]
        bucket, starts = _trigrams([letters[i] for i in run])
        log = np.add.reduceat(model.logp[bucket], starts, axis=0) * TEMPER
        out[run] = np.exp(np.maximum(log - log.max(axis=1, keepdims=True), -30))
    return has, out


def _estimate(r: np.ndarray, doc: np.ndarray, starts: np.ndarray, n: np.ndarray, share: np.ndarray,
              times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of the documents whose words, each as often
    as ``times``, have the likelihoods ``r``, some steps after the guess ``share``."""
    share = share / share.sum(axis=1, keepdims=True)
    times = np.ones(len(r)) if times is None else times
    for _ in range(STEPS):
        p = r * share[doc]
        p *= (times / p.sum(axis=1))[:, None]
        share = np.add.reduceat(p, starts, axis=0) / n[:, None]
    return share, np.add.reduceat(times * np.log((r * share[doc]).sum(axis=1)), starts)


def _runs(starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of runs of ``size`` from ``starts``, one after the other, the
    run of each, and where each begins."""
    begin = np.cumsum(size) - size
    run = np.repeat(np.arange(len(size)), size)
    return np.arange(len(run)) - begin[run] + starts[run], run, begin


def _maximised(r: np.ndarray, starts: np.ndarray, size: np.ndarray, n: np.ndarray, share: np.ndarray,
               times: np.ndarray, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood at its maximum, to the tolerance, of the
    documents whose words are the runs of ``r``; -inf where it is not above ``bar``."""
    log = np.full(len(n), -np.inf)
    share = share.astype(np.float64)
    left = np.arange(len(n))
    while len(left):
        at, doc, begin = _runs(starts[left], size[left])
        own, weight = r[at], times[at]
        share[left], now = _estimate(own, doc, begin, n[left], share[left], weight)
        slope = np.add.reduceat(own * (weight / (own * share[left][doc]).sum(axis=1))[:, None], begin, axis=0)
        gap = slope.max(axis=1) - n[left]  # at most so much below the maximum
        passed = now + gap > bar[left]
        done = passed & (gap <= TOLERANCE)
        log[left[done]] = now[done]
        left = left[passed & ~done]
    return share, log


def _grown(table: np.ndarray, word: np.ndarray, times: np.ndarray, starts: np.ndarray,
           n: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Per document, the number of words that favour each language, the selected
    languages and their proportions.  A document has the words (rows of
    ``table``) from its start to the next one's, each so many ``times``."""
    n_doc, n_lang = len(starts), table.shape[1]
    size = np.diff(starts, append=len(word))

    def summed(of: np.ndarray, at: np.ndarray, begin: np.ndarray, weight: np.ndarray) -> np.ndarray:
        step = max(1, 4_000_000 // max(1, len(at)))
        return np.concatenate([np.add.reduceat(of[word[at], k:k + step] * weight[:, None], begin, axis=0)
                               for k in range(0, n_lang, step)], axis=1)
    whole, log_table = np.arange(len(word)), np.log(table)
    votes = summed(table / table.sum(axis=1, keepdims=True), whole, starts, times)
    by_votes = np.argsort(-votes, axis=1, kind="stable")
    alone = summed(log_table, whole, starts, times)
    pick = np.take_along_axis(alone, by_votes, axis=1).argmax(axis=1)
    first = by_votes[np.arange(n_doc), pick]
    best = alone[np.arange(n_doc), first]      # penalised log-likelihood of the set
    languages, shares = [first[i:i + 1] for i in range(n_doc)], [np.ones(1)] * n_doc
    penalty = PENALTY + np.log(n)
    active, member, share = np.arange(n_doc), first[:, None], np.ones((n_doc, 1))
    while len(active) and member.shape[1] < n_lang:
        at, doc, begin = _runs(starts[active], size[active])
        mix = (table[word[at, None], member[doc]] * share[doc]).sum(axis=1)
        slope = summed(table, at, begin, times[at] / mix) - n[active, None]
        within = np.take_along_axis(slope, member, axis=1).max(axis=1)
        gain = slope + np.maximum(within, 0)[:, None]
        if member.shape[1] == 1:               # nor more than if each word had the better of the two
            for k in range(n_lang):
                more = log_table[word[at], k] - log_table[word[at], member[doc, 0]]
                gain[:, k] = np.minimum(gain[:, k], np.add.reduceat(times[at] * np.maximum(more, 0.0), begin))
        np.put_along_axis(gain, member, -np.inf, axis=1)
        which, new = np.nonzero(gain > penalty[active, None])
        k = member.shape[1]
        value = np.full((len(active), n_lang), -np.inf)
        found = {}
        cost = np.cumsum(size[active[which]] * (k + 1))
        block = cost // 1_000_000 if len(cost) else cost
        for b in np.unique(block):
            own = np.flatnonzero(block == b)
            d, lang = active[which[own]], new[own]
            some = np.concatenate([member[which[own]], lang[:, None]], axis=1)
            place, run, start = _runs(starts[d], size[d])
            r = table[word[place, None], some[run]].astype(np.float64)
            old = (r[:, :k] * share[which[own]][run]).sum(axis=1)
            guess = np.add.reduceat(times[place] * r[:, k] / (r[:, k] + old), start) / n[d]
            guess = np.clip(guess, 1e-9, 1 - 1e-9)[:, None]
            bar = best[d] + k * penalty[d]
            final, log = _maximised(r, start, size[d], n[d], np.concatenate(
                [share[which[own]] * (1 - guess), guess], axis=1), times[place], bar)
            value[which[own], lang] = log - k * penalty[d]
            for i in np.flatnonzero(log > bar):
                found[int(which[own[i]]), int(lang[i])] = final[i]
        top = value.argmax(axis=1)
        grows = np.flatnonzero(value[np.arange(len(active)), top] > best[active])
        best[active[grows]] = value[grows, top[grows]]
        member = np.concatenate([member[grows], top[grows, None]], axis=1)
        share = np.array([found[int(i), int(top[i])] for i in grows]).reshape(len(grows), k + 1)
        active = active[grows]
        for i, m, s in zip(active.tolist(), member, share, strict=True):
            languages[i], shares[i] = m, s
    return votes, languages, shares


def predict(text: pa.Array, model: Model) -> pa.Array:
    """Language, score, languages and their proportions of each text."""
    total, n_lang = len(text), len(model.languages)
    lang = np.full(total, UNKNOWN, object)
    score = np.zeros(total)
    langs: list = [[] for _ in range(total)]
    shares: list = [[] for _ in range(total)]
    found, index, offsets = words(text)
    if n_lang and found:
        has, table = _likelihoods(found, model)
        spoken = has[index]
        offsets = np.concatenate([[0], np.cumsum(spoken)])[offsets]
        index = index[spoken]
        rows = np.flatnonzero(np.diff(offsets))
        n = np.diff(offsets)[rows]
        starts = offsets[:-1][rows]
        if len(rows):
            own = np.repeat(np.arange(len(rows)), n) * len(found) + index
            own, times = np.unique(own, return_counts=True)
            doc, word = np.divmod(own, len(found))
            votes, chosen, proportion = _grown(table, word, times.astype(np.float64),
                                               np.searchsorted(doc, np.arange(len(rows))), n)
            names = np.array(model.languages, object)
            for i, v, t, c in zip(rows.tolist(), votes, chosen, proportion, strict=True):
                order = np.lexsort((t, -v[t], -c))
                langs[i], shares[i] = names[t[order]].tolist(), c[order].tolist()
                lang[i], score[i] = langs[i][0], min(1.0, shares[i][0])
    return pa.StructArray.from_arrays(
        [pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(langs, pa.list_(pa.string())),
         pa.array(shares, pa.list_(pa.float64()))], names=RESULT.names)


def identified(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text",
               name: str = "language") -> DataFrame:
    """``docs`` with a column ``name`` (lang, score, langs, shares): the most
    likely language of each text, its proportion, and all that were selected.

    Text that is null or has no letter is 'und' with score 0; so is every text
    if the model has no language.  Long texts are used whole.  Languages of
    equal proportion go by the number of words that favour them, then by name.
    """
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def language(column: pa.Array) -> pa.Array:
        known = sent.value
        limit = max(1 << 16, SLICE * 4 // max(4, len(known.languages)))
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [predict(part.column("text"), known) for part in slices(batch, "text", limit)]
        return pa.concat_arrays(parts) if parts else predict(column, known)

    return docs.withColumn(name, language(F.col(text)))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept apart from fitting (a null id: its text is
    empty, so it is)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fit on the labelled documents that are not held out and predict all:
    doc_id, held_out, lang_pred, score, langs, shares."""
    model = fit(spark, docs.where(~held_out(F.col("doc_id"))))
    return (identified(spark, docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                    F.col("language.lang").alias("lang_pred"), "language.score", "language.langs",
                    "language.shares"))


@F.arrow_udf(T.BooleanType())
def _lettered(column: pa.Array) -> pa.Array:
    """Whether a text has a letter."""
    out = [np.empty(0, bool)]
    for part in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text", SLICE):
        found, index, offsets = words(part.column("text"))
        has = np.fromiter(map(bool, _letters(found)), bool, len(found))
        out.append(np.diff(np.concatenate([[0], np.cumsum(has[index])])[offsets]) > 0)
    return pa.array(np.concatenate(out))


def spoken(spark: SparkSession, docs: DataFrame, least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` in a known language, with all their columns: those
    without letters go, and, with ``least``, those in which no language has
    such a proportion.  Where no document to fit on has a label, no language is
    known and all with a letter stay; ``least`` is an error then."""
    model = fit(spark, docs.where(~held_out(F.col("doc_id"))))
    if not model.languages:
        if least > 0:
            raise ValueError("no labelled document to fit on, so no language has a proportion")
        return docs.where(_lettered(F.col("text")))
    # the whole row as one column, so that its names clash with none of these
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = identified(spark, rows, model, name="language")
    return found.where((F.col("language.lang") != UNKNOWN) & (F.col("language.score") >= least)).select("row.*")
