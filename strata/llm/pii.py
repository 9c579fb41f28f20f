r"""Personal data by patterns, and by contexts learnt from them.

Base spans are matches of four fixed patterns (e-mail, IP, card, phone) that
pass their checks.  They are the seeds of a bootstrap: every word with a digit
or an @ is a *mention*, the two words before it its context (a mark stands for a
mention there, another for the beginning of the text).  Contexts and the
identifiers they occur with form a bipartite graph.  In each round a context is
as reliable as the share of its distinct identifiers that are known to be of
one kind, and an identifier not known yet is of a kind by the contexts that
vouch for it (noisy or); then it counts as known in the next round, until nothing
is added.  An identifier keeps its kind, so scores only rise.  Mentions of such identifiers in reliable contexts are
added to the base spans.

Only DataFrame functions are used.  Spark's regular expressions give matches
without places, so the texts between the matches are taken as well and places
are prefix sums of lengths.  Repetitions of groups, which recurse in Java, are
avoided: separators inside a number or a domain are marked first, so that one
character class spans it.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WHITE, stage

KINDS = ["email", "ip", "card", "phone"]
SEP, DOT, OTHER = "\ue000", "\ue001", "\ue002"  # private use; those in a text count as OTHER

LOCAL = rf"[A-Za-z0-9._%+\-{DOT}]"
LABEL = r"[A-Za-z0-9-]"
PATTERNS = {
    # a run of local characters is entered at its beginning, or where the last match ended
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++{DOT}[A-Za-z0-9{DOT}-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{SEP}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MENTION = rf"(?<![^{WHITE}])[^{WHITE}0-9@]*+[0-9@][^{WHITE}]*+"
# entered at the beginning of a word only, and without a way back: linear for long words as well
CONTEXT = rf"(?<![^{WHITE}])([^{WHITE}]++[{WHITE}]++[^{WHITE}]++)[{WHITE}]*+$"
BEFORE, BEGIN = SEP, DOT  # in a context: a mention, the beginning of the text; no text has them

SETTLED = 1e-3           # of the sum of all scores, between two rounds
MIN_SEEDS = 5            # distinct known identifiers of a reliable context
MIN_CONTEXT = 0.8
MIN_INSTANCE = 0.8
BLOCK = 256


def _gate(kind: str, text: Column) -> Column:
    """What every text with a match of ``kind`` has; cheap to test."""
    return {"email": text.contains("@"),
            "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
            "card": text.rlike(r"[0-9][0-9\x20-]{10,}[0-9]"),
            "phone": text.contains("+"),
            "mention": text.rlike("[0-9@]")}[kind]


def _prepared(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.regexp_replace(text, rf"\.(?<={LABEL}\.)(?={LABEL})", DOT)
    if kind == "card":
        return F.regexp_replace(text, r"[\x20-](?<=[0-9][\x20-])(?=[0-9])", SEP)
    return text


def _valid(kind: str, match: Column) -> Column:
    value = match["value"]
    if kind == "ip":
        def part(p: Column) -> Column:
            short = F.regexp_replace(p, "^0+", "")
            return F.when(F.length(short) <= 3, F.concat(F.lit("0"), short).cast("int") <= 255) \
                .otherwise(F.lit(False))
        return F.forall(F.split(value, r"\."), part)
    if kind == "card":
        digits = F.translate(value, SEP, "")

        def summand(i: Column) -> Column:  # i from the right, from 1
            d = F.substr(digits, -i, F.lit(1)).cast("int")
            return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
        luhn = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), summand),
                           F.lit(0), lambda a, b: a + b) % 10 == 0
        return F.when(F.length(digits).between(12, 19), luhn).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _located(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """``df`` with the matches of ``pattern`` in the column ``x_<name>`` (null:
    none) as an array of start, end and value; mentions with their context."""
    x, m, g, n, b = (f"{p}_{name}" for p in "xmgnb")
    none = F.array().cast("array<string>")
    df = df.withColumns({
        m: F.coalesce(F.regexp_extract_all(F.col(x), F.lit(pattern), F.lit(0)), none),
        g: F.coalesce(F.split(F.col(x), pattern, -1), none)})
    df = df.withColumn(n, F.zip_with(F.slice(g, 1, F.size(m)), F.col(m),
                                     lambda a, c: F.length(a) + F.length(c)))
    df = df.withColumn(b, F.transform(
        F.sequence(F.lit(0), F.floor(F.size(n) / BLOCK).cast("int")),
        lambda i: _sum(F.slice(F.col(n), i * BLOCK + 1, F.lit(BLOCK)))))

    def place(value: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        ahead = F.element_at(F.col(g), i + 1)
        start = (_sum(F.slice(F.col(b), F.lit(1), block))
                 + _sum(F.slice(F.col(n), block * BLOCK + 1, i % BLOCK)) + F.length(ahead))
        own = [start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value")]
        if name == "mention":  # its last two words are within the texts around the match before
            head = F.concat(F.when(i > 1, BEFORE).otherwise(BEGIN + " "), F.when(
                i > 0, F.concat(F.get(F.col(g), i - 1), F.lit(BEFORE))).otherwise(BEGIN + " "), ahead)
            two = F.regexp_extract(head, CONTEXT, 1)
            own.append(F.lower(F.regexp_replace(two, f"[{WHITE}]+", " ")).alias("context"))
        return F.struct(*own)
    return df.withColumn(f"at_{name}", F.transform(F.col(m), place)).drop(x, m, g, n, b)


def base_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, row (a hash of id and text),
    an array of the base spans (start, end) of each kind, and ``mentions`` with
    start, end, value, context and kind (null: none known)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.when(
        text.contains(SEP) | text.contains(DOT), F.translate(text, SEP + DOT, OTHER * 2))
        .otherwise(text).alias("t"))
    t = F.col("t")
    df = df.select("doc_id", "row", *[
        F.when(_gate(k, t), _prepared(k, t)).alias(f"x_{k}") for k in [*KINDS, "mention"]])
    for kind in KINDS:
        df = _located(df, kind, PATTERNS[kind])
    df = _located(df, "mention", MENTION)
    df = df.select("doc_id", "row", "at_mention", *[
        F.transform(F.filter(f"at_{k}", partial(_valid, k)),
                    lambda s: F.struct(s["start"], s["end"])).alias(k) for k in KINDS])

    def mention(s: Column) -> Column:
        opened = F.length(F.regexp_extract(s["value"], r"""^["'(\[{<]*""", 0))
        closed = F.length(F.regexp_extract(s["value"], r"""[.,;:!?"')\]}>]*$""", 0))
        size = F.length(s["value"]) - opened - closed
        start, end = s["start"] + opened, s["end"] - closed

        def seen(k: str) -> Column:
            return F.exists(k, lambda o: (o["start"] < end) & (o["end"] > start))
        kind = F.coalesce(*[F.when(seen(k), F.lit(k)) for k in KINDS])
        return F.struct(
            start.alias("start"), end.alias("end"),
            F.substr(s["value"], opened + 1, F.greatest(size, F.lit(0))).alias("value"),
            s["context"], kind.alias("kind"))
    return df.select("doc_id", "row", *KINDS, F.filter(
        F.transform("at_mention", mention), lambda s: s["end"] > s["start"]).alias("mentions"))


def bootstrapped(spark: SparkSession, mentions: DataFrame) -> DataFrame:
    """Of ``mentions`` (row, start, end, value, context, kind) those without a
    kind that the graph gives one: row, start, end, kind."""
    edges = stage(spark, mentions.groupBy("context", "value")
                  .agg(F.max("kind").alias("seed")), "op10-edges")
    seeds = edges.where("seed is not null").groupBy("value").agg(
        F.max("seed").alias("kind"), F.lit(1.0).alias("conf"))
    known, found, last = seeds, None, (0, 0, 0.0)
    while True:
        scored = edges.join(known, "value", "left").groupBy("context", "kind").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("conf"), F.lit(0.0)).alias("sure"))
        best = scored.groupBy("context").agg(
            F.sum("n").alias("n"), F.max(F.when(F.col("kind").isNotNull(), F.struct(
                "sure", "kind", F.col("n").alias("known")))).alias("best"))
        trust = F.col("best.sure") / (F.col("n") + 1)
        reliable = stage(spark, best.where((F.col("best.known") >= MIN_SEEDS) & (trust >= MIN_CONTEXT))
                         .select("context", F.col("best.kind").alias("kind"), trust.alias("trust")),
                         "op10-contexts")
        vouched = (edges.where("seed is null").join(reliable, "context").groupBy("value", "kind")
                   .agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("conf"))
                   .where(F.col("conf") >= MIN_INSTANCE))
        if found is None:
            vouched = vouched.withColumn("kept", F.lit(False))
        else:
            vouched = (vouched.join(found.select("value", F.col("kind").alias("old")), "value", "left")
                       .withColumn("kept", F.col("old").eqNullSafe(F.col("kind"))))
        found = stage(spark, vouched.groupBy("value").agg(F.max(F.struct("kept", "conf", "kind")).alias("best"))
                      .select("value", "best.kind", "best.conf"), "op10-instances")
        known = seeds.unionByName(found.join(seeds, "value", "left_anti"))
        total = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("conf"), F.lit(0.0))).first()
        now = (reliable.count(), total[0], total[1])
        if now[:2] == last[:2] and now[2] - last[2] < SETTLED:
            break
        last = now
    return (mentions.where("kind is null").drop("kind").join(found.select("value", "kind"), "value")
            .join(reliable.select("context", "kind"), ["context", "kind"])
            .select("row", "start", "end", "kind"))


def _ranked(rank: int, span: Column) -> Column:
    return F.struct(span["start"].alias("start"), F.lit(rank).alias("rank"), span["end"].alias("end"))


def _written(spans: Column) -> Column:
    """kind:start:end of sorted (start, rank of the kind, end), comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.element_at(names, s["rank"]), F.lit(":"), s["start"].cast("string"), F.lit(":"),
        s["end"].cast("string"))), ",")


def pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card,
    n_phone (base spans), base (the base spans as kind:start:end by start and
    kind, comma-joined), spans (base and added spans, likewise), n_added.

    Places are code points, ends exclusive.  Null and empty text has no spans;
    texts are used whole.  Repeated rows have the same spans each, and count
    once for a context.  An empty table gives an empty result.
    """
    found = stage(spark, base_spans(docs), "op10-base")
    mentions = found.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    added = (bootstrapped(spark, mentions)
             .groupBy(F.col("row").alias("_row")).agg(F.collect_set(F.struct(
                 "start", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
                 .cast("int").alias("rank"), "end")).alias("added")))
    base = F.concat(*[F.transform(k, partial(_ranked, i)) for i, k in enumerate(KINDS, 1)])
    more = F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,end:int>>"))
    return (found.join(added, F.col("row") == F.col("_row"), "left")
            .select("doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
                    _written(F.array_sort(base)).alias("base"),
                    _written(F.array_sort(F.concat(base, more))).alias("spans"),
                    F.size(more).cast("bigint").alias("n_added")))
