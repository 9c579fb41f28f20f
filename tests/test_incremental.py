"""Incremental operators and the streaming sink."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import incremental as inc

T = dt.datetime(2024, 1, 1)


def test_upsert_newest_wins_and_dedups_incoming(spark):
    cur = spark.createDataFrame([("a", 1, T), ("b", 1, T)], "k string, v int, ts timestamp")
    new = spark.createDataFrame([("a", 2, T + dt.timedelta(1)), ("c", 3, T),
                                 ("c", 4, T + dt.timedelta(2))], "k string, v int, ts timestamp")
    out = {r.k: r.v for r in inc.upsert(cur, new, ["k"], ["ts"]).collect()}
    assert out == {"a": 2, "b": 1, "c": 4}


def test_lookback_filter(spark):
    target = spark.createDataFrame([(T,)], "ts timestamp")
    src = spark.createDataFrame([(T - dt.timedelta(hours=h),) for h in (0, 23, 25)], "ts timestamp")
    assert inc.lookback_filter(src, target, "ts", 24).count() == 2
    empty = spark.createDataFrame([], "ts timestamp")
    assert inc.lookback_filter(src, empty, "ts", 24).count() == 3


def test_schema_policies(spark):
    target = spark.createDataFrame([(1, "x")], "a int, b string")
    incoming = spark.createDataFrame([(2, 3)], "a int, c int")
    with pytest.raises(ValueError):
        inc.apply_schema_policy(incoming, target, "fail")
    appended = inc.apply_schema_policy(incoming, target, "append_new_columns")
    assert appended.columns == ["a", "b", "c"] and appended.collect()[0].b is None
    assert inc.apply_schema_policy(incoming, target, "sync_all_columns").columns == ["a", "c"]


@pytest.mark.parametrize("a, b, wide", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("int", "decimal(12,2)", "decimal(12,2)"),
    ("int", "decimal(11,2)", None), ("bigint", "double", None), ("int", "double", "double"),
    ("float", "double", "double"), ("decimal(18,2)", "decimal(20,3)", "decimal(20,3)"),
    ("decimal(18,2)", "decimal(18,3)", None), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("string", "int", None), ("timestamp_ntz", "string", None), ("string", "string", "string")])
def test_wider_type(spark, a, b, wide):
    x, y = (spark.createDataFrame([], f"c {t}").schema["c"].dataType for t in (a, b))
    got = inc.wider(x, y)
    assert (got and got.simpleString()) == wide == ((back := inc.wider(y, x)) and back.simpleString())


def test_changed_types_per_policy(spark):
    target = spark.createDataFrame([(1, 2)], "a bigint, b int")
    narrow = spark.createDataFrame([(5, 6)], "a int, b int")
    wide = spark.createDataFrame([(5, 6)], "a bigint, b bigint")
    unlike = spark.createDataFrame([("5", 6)], "a string, b int")
    for policy in ("append_new_columns", "sync_all_columns"):
        assert inc.apply_schema_policy(narrow, target, policy).dtypes == [("a", "bigint"), ("b", "int")]
        assert inc.apply_schema_policy(wide, target, policy).dtypes == [("a", "bigint"), ("b", "bigint")]
        with pytest.raises(inc.SchemaChange, match="a is bigint, not string"):
            inc.apply_schema_policy(unlike, target, policy)
    for changed in (narrow, wide, unlike):
        with pytest.raises(inc.SchemaChange):
            inc.apply_schema_policy(changed, target, "fail")


def test_differences_name_the_keys(spark):
    rows = [(i, f"k{i % 7}", i * 2, None if i % 5 == 0 else f"v{i}") for i in range(500)] + [(None, None, 1, "n")]
    left = spark.createDataFrame(rows, "a int, b string, x int, y string")
    changed = [(a, b, 0 if a == 17 else x, None if a in (17, 18) else y) for a, b, x, y in rows if a != 250]
    right = spark.createDataFrame([*changed, (900, "k", 1, "w")], left.schema).repartition(5)
    for buckets in (1, 16, 1 << 14):
        got = {(r.a, r.b, r.difference, r.changed, r.left_x, r.right_x) for r in
               inc.differences(left, right, ["a", "b"], ["x", "y"], buckets).collect()}
        assert got == {(17, "k3", "changed", "x,y", 34, 0), (18, "k4", "changed", "y", 36, 36),
                       (250, "k5", "missing right", None, 500, None), (900, "k", "missing left", None, None, 1)}
    assert inc.differences(left, left.repartition(3), ["a", "b"], ["x", "y"]).count() == 0
    assert inc.differing_buckets(left, right, ["a", "b"], ["x", "y"], 1 << 14).count() == 4


def test_reconcile_and_ledger(spark):
    l = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    r = spark.createDataFrame([("a", 1), ("c", 5)], "k string, n int")
    assert sorted(x.k for x in inc.reconcile(l, r, ["k"], ["n"]).collect()) == ["b", "c"]
    ledger = spark.createDataFrame([("x",)], "batch_id string")
    batches = spark.createDataFrame([("x",), ("y",)], "batch_id string")
    assert [x.batch_id for x in inc.unseen_batches(batches, ledger).collect()] == ["y"]


def test_record_ids_deterministic(spark):
    df = spark.createDataFrame([("b1", 1), ("b1", 2)], "batch string, rn bigint")
    ids = [r[0] for r in df.select(inc.record_id("batch", "rn")).collect()]
    again = [r[0] for r in df.select(inc.record_id("batch", "rn")).collect()]
    assert ids == again and len(set(ids)) == 2 and all(len(i) == 64 for i in ids)


def test_replay_fingerprint_stable(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert inc.fingerprint(df, ["k"]).collect() == inc.fingerprint(df.union(df).distinct(), ["k"]).collect()


def test_stream_sink_idempotent_replay(spark, tmp_root):
    from strata.sources.catalog import Catalog
    from strata.streaming.ingest import UpsertSink, event_stream, run_available
    events = spark.createDataFrame(
        [(i, T + dt.timedelta(minutes=i), f"v{i}") for i in range(20)],
        "event_id bigint, ts timestamp, payload string")
    events.write.parquet(f"{tmp_root}/src/one")
    events.where("event_id < 5").write.parquet(f"{tmp_root}/src/two")
    catalog = Catalog(spark, f"{tmp_root}/wh")
    sink = UpsertSink(catalog, "silver", "events", ["event_id"])
    stream = event_stream(spark, f"{tmp_root}/src/*", events.schema, "ts", files_per_trigger=1)
    run_available(stream, sink, f"{tmp_root}/ckpt")
    out = catalog.read("silver", "events")
    assert out.count() == 20 and out.select("event_id").distinct().count() == 20
    seq = catalog.next_seq()
    sink(spark.createDataFrame([], out.schema).drop("_batch_id"), 0)  # replay of batch 0
    assert catalog.next_seq() == seq


def test_stream_sink_partitioned_rewrites_only_touched_days(spark, tmp_root):
    from strata.sources.catalog import Catalog
    from strata.streaming.ingest import UpsertSink
    catalog = Catalog(spark, f"{tmp_root}/wh")
    sink = UpsertSink(catalog, "silver", "ev", ["event_id"], partition_by="day")
    schema = "event_id bigint, _event_time timestamp, day date, v string"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    sink(spark.createDataFrame([(1, T, d1, "a"), (2, T, d2, "b")], schema), 0)
    before = catalog.current("silver")["ev"].paths
    # Batch 1 touches only day 1: day 2 keeps its segment.
    sink(spark.createDataFrame([(1, T + dt.timedelta(hours=1), d1, "a2")], schema), 1)
    after = catalog.current("silver")["ev"].paths
    assert len(before) == len(after) == 2
    assert [p for p in after if p in before] == [p for p in before if p.endswith("day=2024-01-02")]
    out = {r.event_id: r.v for r in catalog.read("silver", "ev").collect()}
    assert out == {1: "a2", 2: "b"}


def test_stream_loses_no_late_event(spark, tmp_root):
    """Files whose events are spread over the whole period, in any order."""
    from strata.sources.catalog import Catalog
    from strata.streaming.ingest import UpsertSink, event_stream, run_available
    rows = [(i, T + dt.timedelta(hours=i), T.date() + dt.timedelta(hours=i).days * dt.timedelta(1))
            for i in range(200)]
    schema = "event_id bigint, ts timestamp, day date"
    for k in range(4):
        spark.createDataFrame(rows[3 - k::4] + rows[:5], schema).write.parquet(f"{tmp_root}/src/{k}")
    catalog = Catalog(spark, f"{tmp_root}/wh")
    sink = UpsertSink(catalog, "silver", "late", ["event_id"], partition_by="day")
    run_available(event_stream(spark, f"{tmp_root}/src/*", spark.createDataFrame([], schema).schema,
                               "ts", files_per_trigger=1), sink, f"{tmp_root}/ckpt")
    out = catalog.read("silver", "late")
    assert out.count() == 200 and out.select("event_id").distinct().count() == 200
    assert "v" not in out.columns


def test_watermark_sink_reopens_old_partitions_once(spark, tmp_root):
    """Files of days in any order: batches write recent days only, late rows wait and are merged together."""
    from strata.sources.catalog import Catalog
    from strata.streaming.ingest import WatermarkSink, event_stream, run_available
    schema = "event_id bigint, ts timestamp, day date, v string"

    def rows(days, v):
        return [(d * 10 + i, T + dt.timedelta(days=d, hours=i), T.date() + dt.timedelta(days=d), v)
                for d in days for i in range(10)]
    files = [rows([5], "a"), rows([9], "b"), rows([1, 9], "c"), rows([2, 8, 9], "d"), rows([1, 2, 10], "e"),
             [(900, None, None, "f")]]
    catalog = Catalog(spark, f"{tmp_root}/wh")
    sink = WatermarkSink(catalog, "silver", "late", ["event_id"], partition_by="day", delay_seconds=36 * 3600)
    stream = spark.createDataFrame([], schema)
    written = []
    for n, own in enumerate(files):
        spark.createDataFrame(own, schema).coalesce(1).write.parquet(f"{tmp_root}/src/{n}")
        run_available(event_stream(spark, f"{tmp_root}/src/*", stream.schema, "ts"), sink, f"{tmp_root}/ckpt")
        paths = catalog.current("silver")["late"].paths if n < 9 else ()
        written.append(sorted(int(p[-2:]) - 1 for p in paths if f"/v=b{n}-" in p and "__" not in p))
    assert written == [[5], [9], [9], [8, 9], [10], []]
    assert {r.day.day - 1 if r.day else None for r in sink.late().select("day").collect()} == {1, 2, None}
    assert sink.watermark(2) == T + dt.timedelta(days=9, hours=9 - 36)
    last = {}
    for own in files:
        last |= {r[0]: r[3] for r in own}
    assert sink.merge_late() == 41 and sink.late() is None and sink.merge_late() == 0
    out = catalog.read("silver", "late")
    assert {r.event_id: r.v for r in out.collect()} == last and out.count() == len(last)


def test_cleanup_keeps_what_is_current(spark, tmp_root):
    from strata.sources.catalog import Catalog
    catalog = Catalog(spark, f"{tmp_root}/wh")
    one = spark.range(3).toDF("x")

    def publish(table, version, **kw):
        catalog.write_version(one, "silver", table, version)
        catalog.publish("silver", {table: (version, 3)}, **kw)
    publish("a", "a1")
    publish("c", "c1")
    publish("c", "c2", append=("c",))
    for v in ("b1", "b2", "b3"):
        publish("b", v)
    catalog.write_version(one, "silver", "b", "unfinished")
    one.write.parquet(catalog.staging_path("silver", "b", "running"))
    removed = catalog.cleanup("silver", keep_publications=1)
    assert sorted(p.rsplit("/", 1)[-1] for p in removed) == ["v=b1", "v=b2"]
    assert catalog.read("silver", "a").count() == 3 and catalog.read("silver", "c").count() == 6
    assert catalog.current("silver")["c"].rows == 6
    assert catalog.read("silver", "b").count() == 3
    assert catalog.spark.read.parquet(catalog.version_path("silver", "b", "unfinished")).count() == 3
    assert catalog.spark.read.parquet(catalog.staging_path("silver", "b", "running")).count() == 3


def test_two_publications_with_one_number_are_refused(spark, tmp_root):
    from strata.sources.catalog import MANIFEST_SCHEMA, Catalog, ManifestError
    catalog = Catalog(spark, f"{tmp_root}/wh")
    rows = [("bronze", 1, p, "t", p, f"{tmp_root}/{p}", 1, T, None) for p in ("p", "q")]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).write.parquet(catalog.manifest_dir)
    with pytest.raises(ManifestError):
        catalog.current("bronze")


def test_keyed_upsert_touches_only_its_buckets(spark, tmp_root):
    from strata.plans.keyed import BUCKET, upsert_into
    from strata.sources.catalog import Catalog
    catalog = Catalog(spark, f"{tmp_root}/wh")
    schema = "k string, j int, v int, ts timestamp"
    rows = [(f"k{i}", i % 3, i, T) for i in range(400)] + [(None, 1, -1, T), (None, 1, -2, T + dt.timedelta(1))]
    first = upsert_into(catalog, "silver", "t", spark.createDataFrame(rows, schema), ["k", "j"], ["ts"], 64, "a")
    assert len(first) == 64
    before = set(catalog.current("silver")["t"].paths)
    new = [("k7", 1, 700, T + dt.timedelta(1)), ("k7", 1, 701, T + dt.timedelta(2)), ("k8", 2, -8, T - dt.timedelta(1)),
           ("new", 0, 1, T), (None, 1, 5, T + dt.timedelta(5))]
    touched = upsert_into(catalog, "silver", "t", spark.createDataFrame(new, schema), ["k", "j"], ["ts"], 64, "b")
    assert 1 <= len(touched) <= 4
    after = set(catalog.current("silver")["t"].paths)
    assert {p.rsplit("=", 1)[1] for p in after - before} == {str(b) for b in touched}
    assert len(after) == 64 and len(after & before) == 64 - len(touched)
    want = {(k, j): v for k, j, v, _ in rows} | {("k7", 1): 701, ("new", 0): 1, (None, 1): 5}
    table = catalog.read("silver", "t")
    assert {(r.k, r.j): r.v for r in table.collect()} == want and table.count() == len(want)
    # what an upsert reads of the table: the filter prunes to the touched buckets
    read = table.where(F.col(BUCKET).isin(touched))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert upsert_into(catalog, "silver", "t", spark.createDataFrame([], schema), ["k", "j"], ["ts"], 64) == []
    with pytest.raises(ValueError, match="32 buckets"):
        upsert_into(catalog, "silver", "t", spark.createDataFrame(new, schema), ["k", "j"], ["ts"], 32)
