"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, scaled by its quality weight; the
smallest keys come first.  A source whose target exceeds its size first gives
complete epochs (every document once more); the rest of the target is taken
along the key order of the source until its words are used up.

No source is sorted whole.  Its keys are dealt into cells of about 256 rows,
the words of the cells are prefix-summed (cells within blocks, then blocks),
and only the one cell where the budget ends is sorted row by row.  The table of
sources has one row per source and is small next to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import collapsed, stage

RANK_WEIGHTS = (5, 2, 1)    # by rank of the source, repeating
CAP = 3                     # epochs at most
CELL_ROWS = 256
BLOCK_CELLS = 1024


def n_words(text: Column) -> Column:
    """Number of runs of characters other than white space (null: 0)."""
    one = F.trim(collapsed(text))
    return F.when(one == "", F.lit(0)).otherwise(
        F.octet_length(one) - F.octet_length(F.replace(one, F.lit(" "), F.lit(""))) + 1
    ).cast("bigint")


def quality(text: Column) -> Column:
    """Weight between 1 and 2: one and the share of letters in the text."""
    return (1 + F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
            / F.greatest(F.length(text), F.lit(1)))


def _by_rank(sources: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in RANK_WEIGHTS]),
        (rank % len(RANK_WEIGHTS) + 1).cast("int")))


def targets(sources: DataFrame, cap: float = CAP) -> DataFrame:
    """``sources`` (source, source_size, weight) with the target of each: a
    share of the total size by weight, at most ``cap`` times the source's size;
    the excess goes to the others by weight until none is above.

    With sources in the order of cap * size / weight, those that reach their
    cap are a prefix, and the level of the others is what remains over their
    weights.
    """
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    most = F.lit(float(cap)) * F.col("source_size")
    level = ((F.sum("source_size").over(Window.partitionBy())
              - F.coalesce(F.sum(most).over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    ranked = sources.withColumn("ratio", most / F.col("weight")).withColumn("level", level)
    open_level = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(
        Window.partitionBy())
    return (ranked.withColumn("open_level", open_level)
            .withColumn("target", F.least(most, F.coalesce(F.col("weight") * F.col("open_level"), most)))
            .drop("ratio", "level", "open_level"))


def _drawn(docs: DataFrame, seed: int, weight: Column | None) -> DataFrame:
    """``docs`` with the number of words and the key of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    unit = ((F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) + 0.5)
            / float(1 << 53))
    return docs.withColumns({
        "_mix_size": n_words(F.col("text")),
        "_mix_key": -F.log(unit) / (quality(text) if weight is None else weight)})


def _cell() -> Column:
    """1 - exp(-key) keeps the key order and is spread over (0, 1)."""
    return F.floor((1 - F.exp(-F.col("_mix_key"))) * F.col("_cells"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _plan(spark: SparkSession, drawn: DataFrame, weights: DataFrame | None, cap: float,
          cell_rows: int) -> DataFrame:
    """One row per source: size, target, epochs, the rest to take after them,
    and the cell of keys in which the rest ends with the words before it."""
    sums = drawn.groupBy("source").agg(F.sum("_mix_size").alias("source_size"),
                                       F.count(F.lit(1)).alias("n"))
    if weights is None:
        sums = _by_rank(sums)
    else:
        sums = (sums.join(weights.select(F.col("source").alias("_named"), "weight"),
                          _same("source", "_named")).drop("_named"))
    wanted = stage(spark, targets(sums, cap).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).alias("epochs"),
        F.ceil(F.col("n") / cell_rows).alias("_cells"))
        .withColumn("_rest", F.round("target").cast("bigint") - F.col("epochs") * F.col("source_size")),
        "op5-targets")
    cells = stage(spark, drawn.join(wanted, _same("source", "_source"))
                  .select("source", _cell().alias("cell"), "_mix_size")
                  .groupBy("source", "cell").agg(F.sum("_mix_size").alias("held"))
                  .withColumn("block", F.floor(F.col("cell") / BLOCK_CELLS)), "op5-cells")

    def before(key: str, order: str) -> Column:
        w = Window.partitionBy(*key.split()).orderBy(order)
        return F.coalesce(F.sum("held").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    blocks = (cells.groupBy("source", "block").agg(F.sum("held").alias("held"))
              .select(F.col("source").alias("_in"), F.col("block").alias("_block"),
                      before("source", "block").alias("block_before")))
    ends = (cells.withColumn("cell_before", before("source block", "cell"))
            .join(blocks, _same("source", "_in") & (F.col("block") == F.col("_block")))
            .withColumn("_before", F.col("block_before") + F.col("cell_before"))
            .join(wanted.select("_source", "_rest"), _same("source", "_source"))
            .where((F.col("_before") < F.col("_rest"))
                   & (F.col("_before") + F.col("held") >= F.col("_rest")))
            .select(F.col("source").alias("_end_of"), F.col("cell").alias("_end_cell"), "_before"))
    return stage(spark, wanted.join(ends, _same("_source", "_end_of"), "left").drop("_end_of"),
                 "op5-plan")


def _placed(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """``drawn`` with its plan and ``part``, the words each row gives after the
    complete epochs.  Only the rows of the cells where a rest ends are sorted."""
    rows = drawn.join(plan, _same("source", "_source")).withColumn("_cell", _cell())
    at_end = _same("_cell", "_end_cell")
    none = F.lit(0).cast("bigint")
    clear = rows.where(~at_end).withColumn(
        "part", F.when(F.col("_cell") < F.col("_end_cell"), F.col("_mix_size")).otherwise(none))
    order = (Window.partitionBy("_source").orderBy("_mix_key", "doc_id")
             .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("_rest") - F.col("_before") - F.coalesce(F.sum("_mix_size").over(order), none)
    return clear.unionByName(rows.where(at_end).withColumn(
        "part", F.greatest(none, F.least(F.col("_mix_size"), left))))


def mix(spark: SparkSession, docs: DataFrame, seed: int = 0, cap: float = CAP,
        weights: DataFrame | None = None, weight: Column | None = None,
        cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, size, its
    source's source_size and target, epochs (times the whole document is
    taken), part (words taken once more, from its beginning), taken.

    ``weights`` (source, weight) gives the shares; without it sources by code
    point, null last, weigh 5, 2, 1, repeating.  Sources that it does not name
    are left out.  ``weight`` is the quality weight of a document, 1 or more;
    the default is 1 plus the share of letters.  Keys come from a hash of the
    seed, the id and the text, so reruns agree; rows that repeat both share a
    key and stand next to each other.  Documents without words (null or empty
    text) are never taken.  An empty table gives an empty result.
    """
    drawn = stage(spark, _drawn(docs.select("doc_id", "text", "source"), seed, weight)
                  .drop("text"), "op5-keys")
    return (_placed(drawn, _plan(spark, drawn, weights, cap, cell_rows))
            .select("doc_id", "source", F.col("_mix_size").alias("size"), "source_size", "target",
                    "epochs", "part",
                    (F.col("epochs") * F.col("_mix_size") + F.col("part")).alias("taken")))


def mixed_documents(spark: SparkSession, docs: DataFrame, seed: int = 0, cap: float = CAP,
                    weights: DataFrame | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time that a
    document is taken.  The document of a source at which the budget ends is
    cut to its first words, joined by single spaces.  Texts are not shuffled,
    but for those of the cell where a source's budget ends."""
    # the whole row as one column, so that its names clash with none of the plan's; written once
    # with its size and key, which take regular expressions over the text
    full = stage(spark, _drawn(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_doc")),
                               seed, None).drop("text"), "op5-drawn")
    light = full.select("doc_id", "source", "_mix_size", "_mix_key")
    rows = _placed(full, _plan(spark, light, weights, cap, cell_rows)).withColumn("text", F.col("_doc")["text"])
    cut = F.array_join(F.slice(F.split(F.trim(collapsed(F.col("text"))), " "),
                               F.lit(1), F.col("part").cast("int")), " ")
    once_more = F.when(F.col("part") == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.when(F.col("part") < F.col("_mix_size"), cut).otherwise(F.col("text"))))
    texts = F.concat(F.array_repeat(F.col("text"), F.col("epochs").cast("int")), once_more)
    return (rows.where(F.col("_mix_size") > 0).withColumn("_taken", F.explode(texts))
            .select(*[F.col("_taken").alias("text") if c == "text" else F.col("_doc")[c].alias(c)
                      for c in docs.columns]))
