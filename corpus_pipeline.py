"""The corpus pipeline: language identification, exact deduplication,
near-duplicate removal, mixing by source, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact_dedup, language_id, minhash_dedup, mixing, packing
from strata.llm.common import remove, stage, staged_inside, table, workers_find_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, whether or not any has a label."""
    return language_id.spoken(spark, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.deduplicated(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash_dedup.without_near_duplicates(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of the mix takes them."""
    return mixing.mixed_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [("language ID", language), ("exact dedup", exact), ("MinHash near-dedup", near),
          ("mixing", mix), ("packing", pack)]

#: SQL can express neither the language models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    docs, before = table(spark, sf_dir, "documents"), []
    for k, (_, step) in enumerate(STAGES[:-1]):
        with staged_inside() as made:
            docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{k}")
        # What the stage has read and written on its way is not needed any more.
        remove(spark, before + made[:-1])
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
