"""Keyed tables: an upsert that leaves untouched data alone.

A keyed table is partitioned by the hash bucket of its key.  An upsert reads
the buckets that the incoming rows fall into, by a filter on the partition
column that prunes the scan, writes their new state as a version of its own and
publishes that in their place.  Other buckets are neither read nor copied.

A key's bucket depends on the number of buckets, which a table keeps for good;
it is written into the table's description and checked.  Choose it so that a
bucket is a few hundred megabytes: then a change of one row in a hundred
rewrites little where changes are clustered or few, and at worst the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.incremental import upsert
from strata.session import scratch_path
from strata.sources import fs
from strata.sources.catalog import Catalog

BUCKET = "key_bucket"


def bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _described(buckets: int) -> str:
    return f"keyed table of {buckets} buckets"


def upsert_into(catalog: Catalog, layer: str, table: str, incoming: DataFrame, keys: Sequence[str],
                order: Sequence[str], buckets: int, publication_id: str | None = None) -> list[int]:
    """Upsert ``incoming`` into a keyed table (made by the first call): of the
    rows of a key the one with the greatest ``order`` stays, also among the
    incoming.  A null in the key is a value like others.  Returns the buckets
    that were rewritten; without incoming rows nothing is published."""
    spark = catalog.spark
    known = catalog.current(layer)
    if table in known:
        said = (catalog.manifest().where((F.col("layer") == layer) & (F.col("table_name") == table)
                                         & F.col("description").isNotNull())
                .select("description").first())
        if said is None or said[0] != _described(buckets):
            raise ValueError(f"{layer}.{table} is not a {_described(buckets)}")
    # Used twice: to find its buckets, and as input of the new state.
    staged = scratch_path(spark, "incoming")
    incoming.withColumn(BUCKET, bucket(keys, buckets)).write.parquet(staged)
    new = spark.read.parquet(staged)
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())     # at most all buckets
    if touched:
        state = upsert(catalog.read(layer, table).where(F.col(BUCKET).isin(touched)), new, keys, order) \
            if table in known else upsert(new.limit(0), new, keys, order)
        version = publication_id or f"upsert-{uuid.uuid4().hex[:12]}"
        catalog.write_version(state, layer, table, version, partition_by=[BUCKET])
        catalog.publish(layer, {table: (version, None)}, publication_id=version,
                        descriptions={table: _described(buckets)}, replace_partitions={table: BUCKET})
    fs.delete(spark, staged)
    return touched
