"""Incremental loading: deterministic ids, load ledger, upsert, look-back
filter, schema-change policy, reconciliation, quarantine and replay checks.

These extend the full-refresh flow with the practices the source system
recommends for production; each is a DataFrame operator.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType, StructField, StructType

from strata.operators.dedup import latest_by
from strata.session import scratch_path
from strata.sources.contracts import Contract
from strata.sources.records import CORRUPT, content_ids, listing

# Fixed value: default look-back window.
LOOKBACK_HOURS = 24


# ---------------------------------------------------------------- ids (EX1, EX2)
def batch_ids(spark: SparkSession, path: str | Sequence[str], glob: str = "*") -> DataFrame:
    """``(source_file, batch_id, bytes, modified_at)`` of the files below
    ``path``: a digest of each file's content, of any size (see
    ``records.content_ids``).  Files without a byte are left out."""
    return (listing(spark, path, glob).join(content_ids(spark, path, glob=glob), "uri")
            .select("source_file", "batch_id", "bytes", "modified_at"))


def record_id(batch_id, row_number) -> Column:
    """Deterministic record id: SHA-256 of ``batch_id || '-' || row_number``."""
    b = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    r = F.col(row_number) if isinstance(row_number, str) else row_number
    return F.sha2(F.concat_ws("-", b, r.cast("string")), 256)


# ---------------------------------------------------------------- ledger (EX3)
# What tells, without reading it, that a file is one that was seen before.
STAMP = ("source_file", "bytes", "modified_at")


def unseen_batches(batches: DataFrame, ledger: DataFrame, key: str | Sequence[str] = "batch_id") -> DataFrame:
    """Batches not yet in the ledger (anti join: never multiplies rows)."""
    keys = [key] if isinstance(key, str) else list(key)
    return batches.join(ledger.select(*keys), keys, "left_anti")


# ---------------------------------------------------------------- upsert (EX4, EX5)
def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """New table state: for every key the newest row of current + incoming.

    A union followed by the same top-1-per-key operator as the Silver dedup
    (map-side partial limit, then one exchange on the key).  Incoming rows are
    deduplicated on the composite key by the same pass.
    """
    both = current.unionByName(incoming, allowMissingColumns=True)
    return latest_by(both, keys, order)


def touched_partitions(incoming: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Distinct partition values an incremental batch touches (EX8): rewrite
    only these (``partitionOverwriteMode=dynamic``)."""
    return incoming.select(*partition_cols).distinct()


# ---------------------------------------------------------------- look-back (EX6)
def lookback_filter(source: DataFrame, target: DataFrame, column: str,
                    hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Source rows at or after the target's newest ``column`` minus a window;
    an empty target takes every row.

    The bound is read first (one value) and becomes a literal of the column's
    own type, so that partitions and row groups of the source are pruned.
    """
    newest = target.agg(F.max(F.col(column))).first()[0]
    if newest is None:
        return source
    limit = F.lit(newest - dt.timedelta(hours=int(hours))).cast(source.schema[column].dataType)
    return source.where(F.col(column) >= limit)


# ---------------------------------------------------------------- schema policy (EX9)
class SchemaChange(ValueError):
    """Incoming columns or types that the policy does not accept."""


# Whole numbers by the digits that any of their values may need.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: DataType, b: DataType) -> DataType | None:
    """Of two types the one that holds every value of the other; None if
    neither does."""
    for narrow, wide in ((a, b), (b, a)):
        n, w = narrow.simpleString(), wide.simpleString()
        if n == w:
            return wide
        if n in _DIGITS and (w in _DIGITS and _DIGITS[n] < _DIGITS[w]
                             or isinstance(wide, DecimalType) and wide.precision - wide.scale >= _DIGITS[n]
                             or w == "double" and _DIGITS[n] <= 10 or w == "float" and _DIGITS[n] <= 5):
            return wide
        if isinstance(narrow, DecimalType) and isinstance(wide, DecimalType) and wide.scale >= narrow.scale \
                and wide.precision - wide.scale >= narrow.precision - narrow.scale:
            return wide
        if (n, w) in (("float", "double"), ("date", "timestamp_ntz"), ("date", "timestamp")):
            return wide
    return None


def apply_schema_policy(incoming: DataFrame, target: DataFrame, policy: str = "fail") -> DataFrame:
    """``fail``: columns and types must match; ``append_new_columns``: keep the
    target's columns and add new ones; ``sync_all_columns``: take the incoming
    columns as they are (dropped ones disappear).

    Under the latter two a column that both have takes the wider of its types,
    so the table's never gets narrower; where neither type holds the other's
    values the change is refused.
    """
    tcols, icols = target.columns, incoming.columns
    if policy not in ("fail", "append_new_columns", "sync_all_columns"):
        raise ValueError(policy)
    if policy == "fail" and set(tcols) != set(icols):
        raise SchemaChange(f"Schema change: missing {sorted(set(tcols) - set(icols))}, "
                           f"new {sorted(set(icols) - set(tcols))}")
    kept: dict[str, Column] = {}
    for c in icols:
        old, new = (target.schema[c].dataType if c in tcols else None), incoming.schema[c].dataType
        kind = new if old is None else wider(old, new)
        if kind is None or policy == "fail" and old != new:
            raise SchemaChange(f"Schema change: {c} is {old.simpleString()}, not {new.simpleString()}")
        kept[c] = F.col(c) if kind == new else F.col(c).cast(kind).alias(c)
    if policy == "sync_all_columns":
        return incoming.select(*kept.values())
    missing = {c: F.lit(None).cast(target.schema[c].dataType).alias(c) for c in tcols if c not in icols}
    return incoming.select(*[(missing | kept)[c] for c in tcols], *[kept[c] for c in icols if c not in tcols])


# ---------------------------------------------------------------- reconciliation (EX10)
def reconcile(left: DataFrame, right: DataFrame, on: Sequence[str],
              measures: Sequence[str]) -> DataFrame:
    """Rows where any measure differs between two aggregates (full outer join
    on the grain; a side without the key counts as 0)."""
    l = left.select(*on, *[F.col(m).alias(f"left_{m}") for m in measures])
    r = right.select(*on, *[F.col(m).alias(f"right_{m}") for m in measures])
    j = l.join(r, list(on), "full_outer")
    diff = F.lit(False)
    for m in measures:
        a, b = F.coalesce(F.col(f"left_{m}"), F.lit(0)), F.coalesce(F.col(f"right_{m}"), F.lit(0))
        diff = diff | (a != b)
    return j.where(diff)


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str],
                      buckets: int) -> DataFrame:
    """The buckets of the key's hash whose rows are not the same on both sides:
    number of rows and two order-free digests differ.  Both sides are aggregated
    on the map side to a row per bucket."""
    def digests(df: DataFrame) -> DataFrame:
        row = F.xxhash64(*keys, *columns)
        return df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"),
            F.sum(F.xxhash64(row).cast("decimal(38,0)")).alias("s"))

    l, r = digests(left), digests(right).select("bucket", *[F.col(c).alias(f"r{c}") for c in ("n", "x", "s")])
    same = F.col("n").eqNullSafe(F.col("rn")) & F.col("x").eqNullSafe(F.col("rx")) & F.col("s").eqNullSafe(F.col("rs"))
    return l.join(r, "bucket", "full_outer").where(~same).select("bucket")


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str],
                buckets: int = 1 << 14) -> DataFrame:
    """The keys by which two tables differ: the key columns, difference (missing
    right, missing left, changed), changed (the columns that differ) and both
    sides' ``columns`` as left_* and right_*.

    First the digests of key buckets are compared; only rows of buckets that
    differ are shuffled and joined.  A null key is a key; a key is expected
    once per side (a repeated one is compared with each of its partners).
    """
    spark = left.sparkSession
    path = scratch_path(spark, "buckets")
    differing_buckets(left, right, keys, columns, buckets).write.parquet(path)
    found = spark.read.parquet(path)

    def narrowed(df: DataFrame, side: str) -> DataFrame:
        rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        return rows.join(found, rows["_bucket"] == found["bucket"], "left_semi").select(
            *[F.col(k).alias(f"_{side}_{k}") for k in keys], F.lit(True).alias(f"_{side}"),
            *[F.col(c).alias(f"{side}_{c}") for c in columns])

    l, r = narrowed(left, "left"), narrowed(right, "right")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"_left_{k}").eqNullSafe(F.col(f"_right_{k}"))
    changed = F.filter(F.array(*[F.when(~F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")), F.lit(c))
                                 for c in columns]), lambda c: c.isNotNull())
    kind = (F.when(F.col("_right").isNull(), "missing right").when(F.col("_left").isNull(), "missing left")
            .when(F.size(changed) > 0, "changed"))
    return (l.join(r, on, "full_outer").withColumn("difference", kind).where(F.col("difference").isNotNull())
            .select(*[F.coalesce(f"_left_{k}", f"_right_{k}").alias(k) for k in keys], "difference",
                    F.when(F.col("difference") == "changed", F.array_join(changed, ",")).alias("changed"),
                    *[f"{side}_{c}" for c in columns for side in ("left", "right")]))


# ---------------------------------------------------------------- quarantine (EX12)
def read_with_quarantine(spark: SparkSession, path: str, contract: Contract, staging: str,
                         multiline: bool = True, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined raw records): malformed rows do not abort the
    load, they are split off with their raw text.

    The file is parsed once, permissively, and written to ``staging`` with the
    corrupt-record column; both outputs are read from that copy, so the parse
    is not repeated (and Spark rejects queries on the corrupt column of a raw
    CSV scan anyway).
    """
    schema = StructType(list(contract.csv_schema().fields) + [StructField(CORRUPT, StringType())])
    parsed = (spark.read.schema(schema).option("header", header).option("quote", '"')
              .option("escape", '"').option("multiLine", multiline).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).csv(path)
              .withColumn("_source_file", F.col("_metadata.file_name")))
    parsed.write.mode("errorifexists").parquet(staging)
    df = spark.read.parquet(staging)
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull()).select("_source_file", CORRUPT)
    return good, bad


# ---------------------------------------------------------------- replay (EX14)
def fingerprint(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order-free fingerprint: rows, distinct keys and a sum of row hashes."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"),
                  F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)"))
                   .alias("row_hash_sum"))
