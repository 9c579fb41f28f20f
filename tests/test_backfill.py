"""Bounded backfill against a full rebuild."""

import pytest
from pyspark.sql import functions as F

from small_data import SF_SMALL

from strata.plans.backfill import backfill, in_months, touched_orders
from strata.plans.build import build, publish_frames
from strata.plans.layers import Layers
from strata.sources import adapters
from strata.sources.catalog import Catalog
from strata.sources.contracts import CONTRACTS

FACTS = ("fact_orders", "fact_order_items", "mart_daily_sales")


@pytest.fixture(scope="module")
def warehouse(spark):
    """A published warehouse, then a load that corrects a month's orders, and a
    late line and a payment of orders of other months."""
    from strata.session import scratch_path
    catalog = Catalog(spark, f"{scratch_path(spark, 'backfill-test')}/wh")
    bronze = adapters.Bronze(spark, SF_SMALL)
    publish_frames(spark, catalog, "bronze", {c.name: bronze[c.name] for c in CONTRACTS}, "b1")
    build(spark, catalog, catalog.reader("bronze"), on_failure="skip", run_id="full")
    lines = bronze["raw_order_items"]
    later = F.lit("2024-01-03 00:00:00").cast("timestamp")
    some = lines.where(F.trim("order_id").isin("7", "200")).limit(2)
    changes = {"raw_orders": adapters.raw_orders_corrections(spark, SF_SMALL),
               "raw_order_items": some.withColumns({"price": F.lit("1.25"), "_loaded_at": later}),
               "raw_order_payments": bronze["raw_order_payments"].where(F.trim("order_id") == "300").limit(1)
               .withColumns({"payment_sequential": F.lit("99"), "_loaded_at": later})}
    before = {t: catalog.current("gold")[t].paths for t in FACTS}
    for name, rows in changes.items():
        catalog.write_version(rows, "bronze", name, "b2")
    catalog.publish("bronze", {t: ("b2", None) for t in changes}, append=tuple(changes))
    new = {t: spark.read.parquet(catalog.version_path("bronze", t, "b2")) for t in changes}
    done = backfill(spark, catalog, new, run_id="fill")
    return catalog, done, before, new


def rows(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("name", FACTS)
def test_backfill_equals_a_full_rebuild(warehouse, name):
    catalog, _, _, _ = warehouse
    whole, got = Layers(catalog.reader("bronze"))[name], catalog.read("gold", name)
    assert rows(got, whole.columns) == rows(whole, whole.columns)


def test_only_touched_partitions_are_written_and_read(spark, warehouse):
    catalog, done, before, new = warehouse
    assert done.orders == touched_orders(new).count() and 199803 in done.months and None in done.months
    for name in ("fact_orders", "fact_order_items"):
        paths = catalog.current("gold")[name].paths
        fresh = {p.rsplit("/", 1)[-1] for p in paths if "/v=fill/" in p}
        kept = {p.rsplit("/", 1)[-1] for p in paths if "/v=full/" in p}
        assert fresh and kept and not fresh & kept
        touched = {f"order_month={'__HIVE_DEFAULT_PARTITION__' if m is None else m}" for m in done.months}
        assert fresh <= touched and not kept & touched
        # the filter by months reaches the scan, so that no other partition is read
        old = spark.read.parquet(*before[name])
        read = old.where(in_months("order_month", done.months))
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "order_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_month_that_loses_all_orders_disappears(spark, tmp_root):
    catalog = Catalog(spark, f"{tmp_root}/wh")
    for n, months in (("v1", (1, 2, None)), ("v2", (3,))):
        df = spark.createDataFrame([(m, n) for m in months], "m int, v string")
        catalog.write_version(df, "gold", "t", n, partition_by=["m"])
        catalog.publish("gold", {"t": (n, None)}, replace_partitions={"t": "m"} if n == "v2" else None,
                        emptied={"t": ["m=1", "m=__HIVE_DEFAULT_PARTITION__"]})
    assert {(r.m, r.v) for r in catalog.read("gold", "t").collect()} == {(2, "v1"), (3, "v2")}


def test_no_changes_publish_nothing(spark, warehouse):
    catalog, _, _, new = warehouse
    seq = catalog.next_seq()
    done = backfill(spark, catalog, {"raw_orders": new["raw_orders"].limit(0)})
    assert (done.publication, done.orders, done.months) == (None, 0, ()) and catalog.next_seq() == seq
