"""Registered queries of the training-data operators, and their oracle SQL.

Each query applies its operator to the whole table it is meant for and derives
the columns of the query's contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import exact_dedup as ed
from strata.llm import language_id as lid
from strata.llm import lexical_search as lx
from strata.llm import license_scan as ls
from strata.llm import line_dedup as ld
from strata.llm import minhash_dedup as mh
from strata.llm import mixing, packing, pii
from strata.llm import periodic_runs as pr
from strata.llm import suffix_dedup as sd
from strata.llm import topk_search as tk
from strata.llm import training_order as to
from strata.llm.common import table, workers_find_package

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ed.exact_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lid.language_id(spark, table(spark, sf_dir, "documents"))


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence as it stands in the shards, with the checksum of its ids."""
    shards = to.materialise(spark, table(spark, sf_dir, "documents"))
    return to.read(spark, shards).select(
        "slot", "shard", "byte", "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ld.line_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "epochs", "part")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tk.exact_top_k(spark, table(spark, sf_dir, "embeddings"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mh.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ls.by_license(ls.license_scan(spark, table(spark, sf_dir, "documents")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"),
        "spans", "n_added")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lx.ranked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the periods that the contract plants in texts by their ids."""
    return pr.periodic_runs(table(spark, sf_dir, "documents"), pr.repeating).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("div(1000 * top.length, top.period)").alias("exponent_milli"),
        F.sha2(pr.described(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sd.without_repeats(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def all_queries() -> dict[str, Query]:
    def ready(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_find_package(spark)
            return query(spark, sf_dir)
        return run

    return {f.__name__: ready(f) for f in (
        op1_exact_dedup, op2_language_id, op3_training_order, op4_line_dedup, op5_mixing,
        op6_packing, op7_topk_search, op8_minhash_dedup, op9_license_scan, op10_pii,
        op11_lexical_search, op12_periodic_runs, op13_suffix_dedup)}


def all_oracles() -> dict[str, str]:
    return {"op1_exact_dedup": ed.ORACLE, "op4_line_dedup": ld.ORACLE, "op7_topk_search": tk.ORACLE,
            "op11_lexical_search": lx.ORACLE,
            "op13_suffix_dedup": sd.ORACLE}
