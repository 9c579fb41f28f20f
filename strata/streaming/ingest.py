"""Streaming ingest with an idempotent upsert sink that loses no late row.

``readStream`` (file source) -> event time as ``timestamp`` -> ``foreachBatch``:
upsert of the micro-batch into the current state of the target table, written
as a new version and published through the manifest.

There is no watermark operator before the sink.  Files arrive in any order of
event time, so it would drop rows; the upsert finds redelivered copies by their
key however late they are, and the state it needs is the table itself.

``WatermarkSink`` bounds what a micro-batch touches by a watermark of its own:
rows that are later than it go to a side table and are merged once, at the end
of a run, instead of reopening old partitions in every batch.

The sink is idempotent: a micro-batch whose publication is already in the
manifest (a replay after a failure) is skipped, and a partial attempt leaves
only an unpublished version directory behind.  The streaming checkpoint lives
in the shared folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.incremental import touched_partitions, upsert
from strata.sources import fs
from strata.sources.catalog import Catalog

EVENT_TIME = "_event_time"
BATCH = "_batch_id"


def event_stream(spark: SparkSession, source_dir: str, schema: StructType, event_time: str,
                 files_per_trigger: int | None = None) -> DataFrame:
    """The files of ``source_dir`` as a stream with an event-time column."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(source_dir).withColumn(EVENT_TIME, F.col(event_time).cast("timestamp"))


class UpsertSink:
    """``foreachBatch`` target: newest row per key wins (event time, then batch).

    Unpartitioned, each micro-batch writes the whole new state as a new
    version (simple, O(table) per batch).  With ``partition_by`` (a column the
    key never moves across, e.g. the event day), a batch reads the partitions
    it touches, writes their new state as a version of its own and publishes
    that in their place: O(touched partitions), and readers see the state
    before or after the batch, never in between.
    """

    def __init__(self, catalog: Catalog, layer: str, table: str, key: Sequence[str],
                 name: str = "stream", partition_by: str | None = None):
        self.catalog, self.layer, self.table = catalog, layer, table
        self.key, self.name, self.partition_by = list(key), name, partition_by

    def publication_id(self, batch_id: int) -> str:
        return f"{self.name}-{self.table}-{batch_id}"

    def already_applied(self, batch_id: int) -> bool:
        m = self.catalog.manifest().where(
            F.col("publication_id") == self.publication_id(batch_id))
        return bool(m.limit(1).collect())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.already_applied(batch_id):
            return
        # The micro-batch is used twice (touched partitions, upsert): keep it
        # instead of recomputing the source.
        incoming = batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            self.merge(incoming, self.publication_id(batch_id), f"b{batch_id}")
        finally:
            incoming.unpersist()

    def merge(self, incoming: DataFrame, publication_id: str, label: str) -> None:
        """Upsert ``incoming`` (with ``BATCH``) and publish the new state."""
        base = (self.catalog.read(self.layer, self.table)
                if self.table in self.catalog.current(self.layer) else incoming.limit(0))
        if self.partition_by:
            base = base.join(touched_partitions(incoming, [self.partition_by]),
                             self.partition_by, "left_semi")
        state = upsert(base, incoming, self.key, [EVENT_TIME, BATCH])
        version = f"{label}-{uuid.uuid4().hex[:8]}"
        if self.partition_by:
            path = self.catalog.version_path(self.layer, self.table, version)
            state.write.partitionBy(self.partition_by).parquet(path)
        else:
            self.catalog.write_version(state, self.layer, self.table, version)
        self.catalog.publish(
            self.layer, {self.table: (version, None)}, publication_id=publication_id,
            replace_partitions={self.table: self.partition_by} if self.partition_by else None)


class WatermarkSink(UpsertSink):
    """An upsert sink whose batches touch recent partitions only.

    The watermark of a batch is the newest event time of the batches before it,
    less ``delay_seconds``.  Rows at or after it are merged at once, older ones
    are appended to a side table in the shared folder; ``merge_late`` merges
    these, all in one publication.  So a batch reads and rewrites the partitions
    of the delay and of the time that it advances, whatever the order of the
    files, and no row is lost.  A replayed batch writes the same again.

    Rows without an event time go to the side table.
    """

    def __init__(self, *args, delay_seconds: int, **kwargs):
        super().__init__(*args, **kwargs)
        self.delay_seconds = delay_seconds
        self.dir = f"{self.catalog.root}/_stream/{self.name}-{self.table}"

    def watermark(self, batch_id: int):
        """The watermark of a batch (a row per earlier batch is kept), or None."""
        path, spark = f"{self.dir}/newest", self.catalog.spark
        if not fs.exists(spark, path):
            return None
        return (spark.read.schema(f"newest timestamp, {BATCH} bigint").parquet(path)
                .where(F.col(BATCH) < batch_id)
                .agg((F.max("newest") - F.expr(f"interval {self.delay_seconds} seconds"))).first()[0])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.already_applied(batch_id):
            return
        limit = self.watermark(batch_id)
        incoming = batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            recent = F.col(EVENT_TIME).isNotNull() if limit is None else \
                F.coalesce(F.col(EVENT_TIME) >= F.lit(limit), F.lit(False))
            incoming.where(~recent).drop(BATCH).write.mode("overwrite").parquet(
                f"{self.dir}/late/{BATCH}={batch_id}")
            (incoming.agg(F.max(EVENT_TIME).alias("newest")).write.mode("overwrite")
             .parquet(f"{self.dir}/newest/{BATCH}={batch_id}"))
            self.merge(incoming.where(recent), self.publication_id(batch_id), f"b{batch_id}")
        finally:
            incoming.unpersist()

    def late(self) -> DataFrame | None:
        """The rows that wait to be merged."""
        path, spark = f"{self.dir}/late", self.catalog.spark
        return spark.read.parquet(path) if fs.exists(spark, path) else None

    def merge_late(self) -> int:
        """Merge the side table and empty it; returns its number of rows.  A
        merge that was interrupted before the side table was emptied is repeated
        and changes nothing."""
        rows = self.late()
        n = 0 if rows is None else rows.count()
        if n:
            label = f"late-{uuid.uuid4().hex[:8]}"
            self.merge(rows.withColumn(BATCH, F.col(BATCH).cast("bigint")), f"{self.name}-{self.table}-{label}", label)
        fs.delete(self.catalog.spark, f"{self.dir}/late")
        return n


def run_available(stream: DataFrame, sink: UpsertSink, checkpoint_dir: str) -> None:
    """Process everything available now, then stop (batch-style scheduling of
    a streaming query; the checkpoint makes the next run incremental)."""
    query = (stream.writeStream.foreachBatch(sink)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise RuntimeError(str(err))
