"""Exact deduplication with an extendible-hash index on shared files.

Every text has a 64-bit key, the hash of its normalised form.  The index maps
keys to *entries*, one per distinct text.  Its directory starts as one bucket;
while a bucket holds more entries than its capacity, the directory doubles and
the overfull buckets split on the next bit of the key.  Owner tasks get ranges
of the buckets, chain the entries whose keys collide, and write the buckets to
the shared folder.  Texts are told apart by grouping on their bytes; a key
alone never decides.

Only DataFrame functions are used.  Groups of copies are combined on the map
side, so a group with a third of all rows reaches a reducer as one row per map
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import collapsed, stage, without_rows

CAPACITY = 1 << 15      # entries in a bucket before it splits
SPARE_BITS = 4          # the directory's finest cells: 2**4 to a full bucket
KEY_BITS = 64


def _keyed(docs: DataFrame, key_bits: int) -> DataFrame:
    text = docs.select(F.col("doc_id"), collapsed(F.col("text")).alias("norm"))
    key = F.xxhash64("norm")
    if key_bits < KEY_BITS:  # a weak key, to test the chains
        key = F.shiftleft(key, KEY_BITS - key_bits)
    return text.withColumn("key", key)


def entries(docs: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per distinct normalised text: key, smallest doc_id, number of
    rows, SHA-256.  The grouping compares the texts byte by byte."""
    return (_keyed(docs, key_bits).groupBy("key", "norm")
            .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select("key", "keep_id", "group_size", F.sha2("norm", 256).alias("sha")))


def directory(spark: SparkSession, found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The directory after all doublings: cell (the first bits of a key),
    depth and bucket (the first ``depth`` bits).  It has 2**4 cells to a bucket
    and is a table like any other."""
    total = found.count()
    bits = max(1, (total // capacity).bit_length() + SPARE_BITS)
    cells = stage(spark, found.groupBy(F.shiftrightunsigned("key", KEY_BITS - bits).alias("cell"))
                  .agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("depth", F.lit(0)), "op1-cells")
    bucket = F.expr(f"shiftright(cell, {bits} - depth)").alias("bucket")
    for _ in range(bits):
        full = (cells.groupBy("depth", bucket).agg(F.sum("n").alias("held"))
                .where(F.col("held") > capacity))
        if full.isEmpty():
            break
        cells = stage(spark, cells.select("cell", "n", "depth", bucket)
                      .join(full, ["depth", "bucket"], "left")
                      .select("cell", "n", (F.col("depth") + F.col("held").isNotNull().cast("int"))
                              .alias("depth")), "op1-cells")
    return cells.select("cell", "depth", bucket, F.lit(bits).alias("bits"))


def build_index(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY,
                key_bits: int = KEY_BITS) -> DataFrame:
    """The index as written to the shared folder, a folder per bucket: key,
    chain (position among the entries of a key, from 1), keep_id, group_size,
    sha, depth, bucket."""
    found = stage(spark, entries(docs, key_bits), "op1-entries")
    cells = directory(spark, found, capacity)
    bits = cells.agg(F.max("bits")).first()[0] or 1
    owned = (found.withColumn("cell", F.shiftrightunsigned("key", KEY_BITS - bits))
             .join(cells.select("cell", "depth", "bucket"), "cell")
             .repartitionByRange("bucket", "key"))
    chain = Window.partitionBy("bucket", "key").orderBy(F.col("keep_id").asc_nulls_last(), "sha")
    same = Window.partitionBy("bucket", "key", "sha")
    one = F.when(F.count(F.lit(1)).over(same) > 1,
                 F.raise_error(F.lit("two texts have the same key and the same SHA-256")))
    return stage(spark, owned.withColumn("chain", F.coalesce(one.cast("int"),
                                                             F.row_number().over(chain)))
                 .select("key", "chain", "keep_id", "group_size", "sha", "depth", "bucket"),
                 "op1-index", "bucket")


def exact_dedup(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY,
                key_bits: int = KEY_BITS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept,
    text_sha256, and key (the index key of its text).

    Texts are equal when they are after every run of white space became one
    space.  Null text counts as empty.  Of equal texts the smallest doc_id
    stays; null ids come last, and of repeated rows (same id, equal text) one
    stays.  An empty table gives an empty result.  Other columns are ignored.
    """
    index = build_index(spark, docs, capacity, key_bits)
    rows = (_keyed(docs, key_bits)
            .select("doc_id", "key", F.sha2("norm", 256).alias("sha"))
            .groupBy("doc_id", "key", "sha").agg(F.count(F.lit(1)).alias("n")))
    return (rows.join(index.select("key", "sha", "keep_id", "group_size"), ["key", "sha"])
            .select("doc_id", "keep_id", "group_size", "key", "sha",
                    F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
                    .alias("kept"),
                    F.col("sha").alias("text_sha256"), "key"))


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns."""
    judged = stage(spark, exact_dedup(spark, docs).groupBy("doc_id", "key")
                   .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "op1-judged")
    return without_rows(docs, F.xxhash64(collapsed(F.col("text"))), judged.where("not kept"),
                        stage(spark, judged.where("kept and n > 1"), "op1-repeated"))


ORACLE = r"""
with d as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t
    from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""
