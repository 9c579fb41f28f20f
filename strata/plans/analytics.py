"""Analytic queries over the Gold schema.

Join order is written deliberately (Spark does not reorder joins without CBO
statistics): dimensions are joined with each other first, where they are small,
so that the items meet one lookup by their own key (product, seller) and are
never shuffled by a key of few values (category, geography).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans.gold import MONEY_SUM


def load_run_history(run_audit: DataFrame) -> DataFrame:
    """Bronze load history, newest start first (AQ1)."""
    return run_audit.select(
        "load_id", "status", "expected_files", "loaded_files", "expected_rows",
        "loaded_rows", "started_at", "completed_at", "error_message",
    ).orderBy(F.col("started_at").desc_nulls_first())


def daily_sales_overview(mart: DataFrame) -> DataFrame:
    """Day-by-day revenue overview (AQ2)."""
    return mart.select("date_day", "order_count", "item_value", "freight_value",
                       "payment_value", "average_review_score").orderBy("date_day")


def category_quality(fact_order_items: DataFrame, dim_product: DataFrame,
                     dim_product_category: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Revenue and delivery quality by category (AQ3).

    The averages are per item row (an order with three items weighs three
    times), as in the source query.
    """
    items = fact_order_items.select("order_id", "product_key", "price")
    orders = fact_orders.select("order_id", "delivery_days", "average_review_score")
    category = dim_product_category.select("product_category_key", "category_name_english")
    product = (dim_product.select("product_key", "product_category_key")
               .join(category, "product_category_key", "left")
               .select("product_key", "category_name_english"))
    joined = items.join(orders, "order_id", "inner").join(product, "product_key", "inner")
    return (joined.groupBy("category_name_english")
                  .agg(F.countDistinct("order_id").alias("orders"),
                       F.sum("price").cast(MONEY_SUM).alias("item_value"),
                       F.avg("delivery_days").alias("average_delivery_days"),
                       F.avg("average_review_score").alias("average_review_score"))
                  .orderBy(F.col("item_value").desc_nulls_first()))


def seller_geography(fact_order_items: DataFrame, dim_seller: DataFrame,
                     dim_geography: DataFrame) -> DataFrame:
    """Seller performance by the seller's geography (AQ4)."""
    items = fact_order_items.select("order_id", "seller_key", "gross_item_value")
    geo = dim_geography.select("geography_key", "state_code", "city")
    seller = (dim_seller.select("seller_key", "geography_key").join(geo, "geography_key", "left")
              .select("seller_key", "state_code", "city"))
    joined = items.join(seller, "seller_key", "inner")
    return (joined.groupBy("state_code", "city")
                  .agg(F.countDistinct("seller_key").alias("sellers"),
                       F.countDistinct("order_id").alias("orders"),
                       F.sum("gross_item_value").cast(MONEY_SUM).alias("gross_item_value"))
                  .orderBy(F.col("gross_item_value").desc_nulls_first()))
