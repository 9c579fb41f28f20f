"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import fs

# White space of the contracts: space and the five ASCII controls 9 to 13.
WHITE = r"\x20\x09-\x0D"

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_open: list[list[str]] = []


@contextmanager
def staged_inside() -> Iterator[list[str]]:
    """The folders of the tables that are staged inside the block, in order."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open[:] = [x for x in _open if x is not made]


def remove(spark: SparkSession, made: list[str], *keep: str) -> None:
    """Delete staged tables but those of the names ``keep``, which a lazy result
    still reads."""
    for path in made:
        if path.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in keep:
            fs.delete(spark, path)


def stage(spark: SparkSession, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.  It
    cuts the lineage; lost executors do not lose it, and the planner knows its
    size."""
    path = scratch_path(spark, name)
    for made in _open:
        made.append(path)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collapsed(text: Column) -> Column:
    """``text`` (null as empty) with each run of white space as one space.
    Single spaces, nearly all of the white space, are left untouched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")),
                            rf"\x20[{WHITE}]+|[\x09-\x0D][{WHITE}]*", " ")


def without_rows(docs: DataFrame, key: Column, gone: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those that ``gone`` names, and of those that
    ``repeated`` names one each.  Both have doc_id and key, a row for each pair,
    where ``key`` is the hash that rows of ``docs`` have; a null doc_id is a
    value like others.  A row travels as one column, so that its names clash
    with none of these."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), key.alias("key"))

    def named(by: DataFrame, how: str) -> DataFrame:
        by = by.select(F.col("doc_id").alias("by_id"), F.col("key").alias("by_key"))
        return rows.join(by, F.col("id").eqNullSafe(F.col("by_id")) & (F.col("key") == F.col("by_key")), how)

    single = named(gone.select("doc_id", "key").unionByName(repeated.select("doc_id", "key")), "left_anti")
    one = named(repeated, "left_semi").dropDuplicates(["id", "key"])
    return single.select("row.*").unionByName(one.select("row.*"))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``max_bytes`` of ``column``, at least
    a row each, so that a task's memory does not follow the batch size.  Between
    two runs Arrow gives back what it holds but does not use: workers live on
    from task to task."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                       .cast(pa.int64())) if batch.num_rows else np.empty(0, np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > max_bytes:
            yield batch.slice(start, i - start)
            pa.default_memory_pool().release_unused()
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
        pa.default_memory_pool().release_unused()


def words(text: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of ``text`` (split at ASCII white space, null as
    empty), the index of each word of each row, and the offsets of the rows in
    that index (one more than rows)."""
    split = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat, offsets = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    coded = pc.dictionary_encode(flat)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    index = np.asarray(coded.indices).astype(np.int64)
    if b"" in distinct:  # white space at an end of a text
        empty = distinct.index(b"")
        full = index != empty
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        index = index[full]
    return distinct, index, offsets


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers of local sessions import this package from where the
    driver has it.  On a cluster it is installed or sent with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
