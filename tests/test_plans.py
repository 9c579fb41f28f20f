"""Plan-shape tests: the scale properties the design relies on, read from the
physical plans Catalyst produces (so a refactor cannot silently lose them)."""

import pytest

from strata.plans.catalogue import layers
from strata.plans.layers import GOLD, SILVER

from small_data import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return layers(spark, SF_SMALL)


def test_dedup_limits_each_key_before_the_shuffle(tables):
    p = plan(tables["stg_order_items"])
    assert "WindowGroupLimit" in p and ", Partial" in p and ", Final" in p
    # the partial limit sits below the exchange
    assert p.index(", Final") < p.index("Exchange hashpartitioning") < p.index(", Partial")


@pytest.mark.parametrize("name", list(SILVER) + list(GOLD))
def test_no_cartesian_or_nested_loop_join(tables, name):
    p = plan(tables[name])
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_mart_aggregates_before_it_joins_the_calendar(tables):
    p = plan(tables["mart_daily_sales"])
    # the fact is aggregated to the day (partial + final) below the join
    assert "partial_count(distinct" in p or "partial_count(" in p


def test_fact_orders_aggregates_children_before_joining(tables):
    p = plan(tables["fact_orders"])
    for fn in ("partial_max(payment_installments", "partial_avg(", "partial_sum(price"):
        assert fn in p
    # no join on the raw child rows: every child enters the joins aggregated
    assert p.count("LeftOuter") == 3


def test_scans_are_pruned(tables):
    p = plan(tables["dim_date"])
    # the calendar needs only the order key (dedup), status-free dates of orders
    scan = p[p.index("FileScan parquet"):]
    scan = scan[:scan.index("]")]
    assert "o_orderpriority" in scan or "o_orderdate" in scan
    assert "o_totalprice" not in scan and "o_custkey" not in scan
