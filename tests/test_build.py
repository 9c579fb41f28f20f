"""Full-refresh build: gates, publication, stored results, partitioned facts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import suite
from strata.plans.build import GateFailed, build, publish_frames
from strata.sources.adapters import Bronze
from strata.sources.catalog import Catalog
from strata.sources.contracts import CONTRACTS

from small_data import SF_SMALL

from strata.sources.adapters import LOAD_TIME as LOADED


def _bronze(spark, catalog):
    b = Bronze(spark, SF_SMALL)
    publish_frames(spark, catalog, "bronze", {c.name: b[c.name] for c in CONTRACTS}, "b1")
    return catalog.reader("bronze")


WARN = {"severity": "warn"}
# What the test data's dirt fails, layer by layer.
DIRTY = {"bronze": ["unique:raw_customers.customer_id"],
         "silver": ["unique:stg_customers.customer_id", "unique:stg_order_items.order_id+order_item_id",
                    "accepted_values:stg_order_reviews.review_score"],
         "gold": ["unique:dim_customer.customer_key", "unique:fact_order_items.order_id+order_item_id",
                  "expression:fact_orders.delivery_not_before_purchase",
                  "expression:fact_orders.non_negative_order_amounts"]}


@pytest.mark.parametrize("layer, published", [("bronze", {}), ("silver", {}), ("gold", {"silver": 9})])
def test_gate_stops_before_publishing(spark, tmp_root, layer, published):
    """The gate of each layer: the layers before it only warn."""
    order = list(DIRTY)
    limits = {t: WARN for x in order[:order.index(layer)] for t in DIRTY[x]}
    catalog = Catalog(spark, f"{tmp_root}/wh")
    with pytest.raises(GateFailed) as err:
        build(spark, catalog, _bronze(spark, catalog), on_failure="raise", run_id="r1",
              check_freshness=False, limits=limits)
    assert f"'{layer}'" in str(err.value)
    assert all(t in str(err.value) for t in DIRTY[layer])
    assert {x: len(catalog.current(x)) for x in ("silver", "gold") if catalog.current(x)} == published
    results = catalog.test_results().where(F.col("run_id") == "r1")
    assert results.where("status = 'fail'").count() == len(DIRTY[layer])
    assert {r.test_name for r in results.where("status = 'warn'").collect()} == set(limits)
    assert {r.layer for r in results.select("layer").distinct().collect()} == set(order[:order.index(layer) + 1])


def test_limits_between_pass_warn_and_error(spark, tmp_root):
    """4 customers arrive twice: what that means depends on the test's limits; the trend compares the runs."""
    name = DIRTY["bronze"][0]
    catalog = Catalog(spark, f"{tmp_root}/wh")
    bronze = _bronze(spark, catalog)
    for run, (limit, status) in enumerate([({}, "fail"), ({"error_above": 3}, "fail"), ({"error_above": 4}, "warn"),
                                           ({"error_above": 9, "warn_above": 4}, "pass"), (WARN, "warn")]):
        try:
            build(spark, catalog, bronze, on_failure="raise", run_id=f"r{run}", check_freshness=False,
                  limits={name: limit, **{t: WARN for x in ("silver", "gold") for t in DIRTY[x][:1]}})
        except GateFailed:
            pass
        got = catalog.test_results().where((F.col("run_id") == f"r{run}") & (F.col("test_name") == name)).first()
        assert (got.failures, got.status) == (4, status), limit
    trend = suite.trend(catalog.test_results()).where(F.col("test_name") == name).orderBy("run_id").collect()
    assert [(r.failures_before, r.change, r.runs_not_passed) for r in trend] == \
        [(None, None, 1), (4, 0, 2), (4, 0, 3), (4, 0, 0), (4, 0, 1)]
    with pytest.raises(KeyError):
        build(spark, catalog, bronze, limits={"unique:nothing.at_all": WARN})


def test_warn_build_publishes_everything(spark, tmp_root):
    catalog = Catalog(spark, f"{tmp_root}/wh")
    res = build(spark, catalog, _bronze(spark, catalog), on_failure="warn", run_id="r2")
    assert set(res.published) == {"silver", "gold"}
    assert len(catalog.current("silver")) == 9 and len(catalog.current("gold")) == 9
    fact = catalog.read("gold", "fact_orders")
    assert "order_month" in fact.columns
    month = fact.select("order_month").where("order_month is not null").limit(1).collect()[0][0]
    assert fact.where(F.col("order_month") == month).count() > 0
    docs = {r.table_name: r.description for r in catalog.manifest().where("layer = 'gold'").collect()}
    assert docs["mart_daily_sales"]
    # 82 declared tests + 9 source freshness checks (the 2024 load is stale now)
    r2 = catalog.test_results().where(F.col("run_id") == "r2")
    assert r2.count() == 91
    assert r2.where("test_name like 'freshness:%' and status = 'fail'").count() == 9


def test_stale_sources_stop_the_build(spark, tmp_root):
    catalog = Catalog(spark, f"{tmp_root}/wh")
    with pytest.raises(GateFailed) as err:
        build(spark, catalog, _bronze(spark, catalog), on_failure="raise", run_id="r3")
    assert "'bronze'" in str(err.value) and "freshness:raw_orders._loaded_at" in str(err.value)
    assert catalog.current("silver") == {}
    fresh = catalog.test_results().where("run_id = 'r3' and test_name like 'freshness:%'")
    assert fresh.count() == 9


def test_freshness_clock(spark, tmp_root):
    catalog = Catalog(spark, f"{tmp_root}/wh")
    with pytest.raises(GateFailed) as err:
        build(spark, catalog, _bronze(spark, catalog), on_failure="raise", run_id="r4",
              freshness_now=LOADED + dt.timedelta(hours=1))
    # Loads of 2024-01-01 are fresh an hour later; the line-item extracts
    # (loaded at their ship dates) are not, and stop the build at Bronze.
    msg = str(err.value)
    assert "freshness:raw_order_items._loaded_at" in msg and "raw_orders._loaded_at" not in msg
