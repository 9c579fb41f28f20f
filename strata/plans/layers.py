"""Lazy composition of the layers: Bronze -> Silver -> Gold.

``Layers`` resolves a model name to its DataFrame and memoises the DataFrame
object (not its data), so a Silver table used by three Gold models is one
sub-plan: within one query Spark reuses its exchanges, and ``plans.build``
writes it once and reads the written copy downstream.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from strata.plans import gold as g
from strata.plans import silver as s

# Gold model -> (builder, inputs)
GOLD: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_customer": (g.dim_customer, ("stg_customers",)),
    "dim_seller": (g.dim_seller, ("stg_sellers",)),
    "dim_product": (g.dim_product, ("stg_products",)),
    "dim_product_category": (g.dim_product_category,
                             ("stg_product_categories", "stg_products")),
    "dim_geography": (g.dim_geography, ("stg_geolocation", "stg_customers", "stg_sellers")),
    "dim_date": (g.dim_date, ("stg_orders",)),
    "fact_orders": (g.fact_orders, ("stg_orders", "stg_order_items", "stg_order_payments",
                                    "stg_order_reviews")),
    "fact_order_items": (g.fact_order_items, ("stg_order_items", "stg_orders")),
    "mart_daily_sales": (g.mart_daily_sales, ("dim_date", "fact_orders")),
}

SILVER = s.MODELS

# The Silver models of an order, as fact_orders takes them.
ORDER_MODELS = GOLD["fact_orders"][1]

# Table descriptions, persisted with every publication (manifest) and as the
# comment of the written table's schema.
DESCRIPTIONS = {
    "stg_customers": "Customers, one row per raw customer id, ZIP padded to five digits.",
    "stg_geolocation": "One coordinate (mean) and locality (minimum) per ZIP prefix.",
    "stg_order_items": "Order lines, typed, newest copy per raw (order, line) key.",
    "stg_order_payments": "Payments, typed, newest copy per raw (order, sequence) key.",
    "stg_order_reviews": "Reviews, typed, newest copy per raw (review, order) key.",
    "stg_orders": "Orders with typed lifecycle timestamps and lower-case status.",
    "stg_products": "Products with parsed sizes and weights.",
    "stg_sellers": "Sellers, ZIP padded to five digits.",
    "stg_product_categories": "Category names with their English translation.",
    "dim_customer": "Customer dimension keyed by customer id, pointing to geography.",
    "dim_seller": "Seller dimension pointing to the shared geography dimension.",
    "dim_product": "Product dimension with its category key and volume.",
    "dim_product_category": "Category outrigger: every known category and its translation.",
    "dim_geography": "Geography per ZIP prefix: geolocation, else customers, else sellers.",
    "dim_date": "Calendar from the first purchase day to the last relevant order day.",
    "fact_orders": "Order grain: item, payment, review and delivery metrics.",
    "fact_order_items": "Order-line grain with product, seller, customer and date keys.",
    "mart_daily_sales": "Daily KPIs over dated orders.",
}

# Facts are written partitioned by order month, so date-range readers prune
# files and joins filtered on the calendar can use dynamic partition pruning.
PARTITION_BY = {"fact_orders": "order_month", "fact_order_items": "order_month"}


class Layers:
    """Resolve ``raw_*``, ``stg_*`` and Gold names against a Bronze source.

    ``bronze`` maps a raw table name to its DataFrame (an adapter, a catalog
    reader, or a dict).  ``overrides`` substitutes any model by a given
    DataFrame, e.g. the written copy of a Silver table.
    """

    def __init__(self, bronze: Mapping[str, DataFrame] | object,
                 overrides: Mapping[str, DataFrame] | None = None):
        self._bronze = bronze
        self._memo: dict[str, DataFrame] = dict(overrides or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = self._build(name)
        return self._memo[name]

    def _build(self, name: str) -> DataFrame:
        if name in SILVER:
            fn, raw = SILVER[name]
            return fn(self[raw])
        if name in GOLD:
            fn, inputs = GOLD[name]
            return fn(*[self[i] for i in inputs])
        return self._bronze[name]
