"""Gold layer: snowflake schema of dimensions, facts and the daily sales mart.

Plan notes (what each join/aggregate costs at scale):

* ``fact_orders`` aggregates items, payments and reviews to the order grain
  *before* joining them to orders.  Each aggregate is hash-partitioned on
  ``order_id`` by its own exchange (after map-side partial aggregation), so the
  three left joins only shuffle the orders side once and never fan out.
* ``dim_date`` spans all order dates; joins with it and with the other
  dimensions are left to Spark's size-checked choice: AQE turns a
  sort-merge join into a broadcast only when the measured side is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps the shuffle
  join otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.functions.dates import date_key, days_between
from strata.operators import calendar as cal
from strata.operators.dedup import pick_by_priority

MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(38, 2)


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        F.col("customer_id").alias("customer_key"), "customer_id",
        "customer_unique_id", F.col("zip_code_prefix").alias("geography_key"))


def dim_seller(stg_sellers: DataFrame) -> DataFrame:
    return stg_sellers.select(
        F.col("seller_id").alias("seller_key"), "seller_id",
        F.col("zip_code_prefix").alias("geography_key"))


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(
        F.col("product_id").alias("product_key"), "product_id",
        F.col("category_name").alias("product_category_key"),
        "name_length", "description_length", "photos_quantity", "weight_g",
        "length_cm", "height_cm", "width_cm",
        (F.col("length_cm") * F.col("height_cm") * F.col("width_cm")).alias("volume_cm3"))


def dim_product_category(stg_product_categories: DataFrame,
                         stg_products: DataFrame) -> DataFrame:
    """Distinct category names from both sources, with their translation.

    A NULL category from the translation side is kept (the not-null check
    reports it); NULLs from products are filtered.
    """
    names = (stg_product_categories.select("category_name")
             .union(stg_products.where(F.col("category_name").isNotNull())
                    .select("category_name"))
             .distinct())
    translations = stg_product_categories.select("category_name", "category_name_english")
    joined = names.alias("n").join(
        translations.alias("t"),
        F.col("n.category_name") == F.col("t.category_name"), "left")
    return joined.select(
        F.col("n.category_name").alias("product_category_key"),
        F.col("n.category_name").alias("category_name"),
        F.col("t.category_name_english").alias("category_name_english"))


def dim_geography(stg_geolocation: DataFrame, stg_customers: DataFrame,
                  stg_sellers: DataFrame) -> DataFrame:
    """Geography per ZIP prefix: geolocation first, then customers, then sellers."""
    null_double = F.lit(None).cast("double")

    def from_parties(df: DataFrame, priority: int) -> DataFrame:
        return (df.where(F.col("zip_code_prefix").isNotNull())
                  .groupBy("zip_code_prefix")
                  .agg(F.min("city").alias("city"), F.min("state_code").alias("state_code"))
                  .select("zip_code_prefix", "city", "state_code",
                          null_double.alias("latitude"), null_double.alias("longitude"),
                          F.lit(priority).alias("source_priority")))

    candidates = (stg_geolocation.select(
                      "zip_code_prefix", "city", "state_code", "latitude", "longitude",
                      F.lit(1).alias("source_priority"))
                  .unionByName(from_parties(stg_customers, 2))
                  .unionByName(from_parties(stg_sellers, 3)))
    return pick_by_priority(candidates, ["zip_code_prefix"]).select(
        F.col("zip_code_prefix").alias("geography_key"), "zip_code_prefix",
        "city", "state_code", "latitude", "longitude")


def date_bounds(stg_orders: DataFrame) -> DataFrame:
    """One row: first purchase day and last purchase/delivery/estimate day."""
    last = F.greatest(F.to_date("purchased_at"), F.to_date("delivered_to_customer_at"),
                      F.to_date("estimated_delivery_at"))
    return stg_orders.agg(
        F.coalesce(F.min(F.to_date("purchased_at")), F.lit(cal.DEFAULT_START)).alias("min_date"),
        F.coalesce(F.max(last), F.lit(cal.DEFAULT_END)).alias("max_date"))


def dim_date(stg_orders: DataFrame) -> DataFrame:
    return cal.calendar(date_bounds(stg_orders))


def item_metrics(stg_order_items: DataFrame) -> DataFrame:
    return stg_order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.countDistinct("product_id").alias("distinct_product_count"),
        F.countDistinct("seller_id").alias("distinct_seller_count"),
        F.sum("price").alias("item_value"),
        F.sum("freight_value").alias("freight_value"))


def item_metrics_in_place(stg_order_items: DataFrame) -> DataFrame:
    """``item_metrics`` of lines that lie in buckets of their order (those
    without an order, which none joins, left out): one distinct count to an
    aggregation, as for two in one Spark multiplies the lines and shuffles them."""
    by_order = stg_order_items.groupBy("order_id")
    products = by_order.agg(
        F.count(F.lit(1)).alias("item_count"),
        F.countDistinct("product_id").alias("distinct_product_count"),
        F.sum("price").alias("item_value"),
        F.sum("freight_value").alias("freight_value"))
    return products.join(by_order.agg(F.countDistinct("seller_id").alias("distinct_seller_count")), "order_id")


def payment_metrics(stg_order_payments: DataFrame) -> DataFrame:
    return stg_order_payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("payment_value").alias("payment_value"),
        F.max("payment_installments").alias("max_payment_installments"))


def review_metrics(stg_order_reviews: DataFrame) -> DataFrame:
    # The mean is taken in double: a mean of integer scores is not an integer.
    return stg_order_reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg(F.col("review_score").cast("double")).alias("average_review_score"))


def fact_orders(stg_orders: DataFrame, stg_order_items: DataFrame,
                stg_order_payments: DataFrame, stg_order_reviews: DataFrame,
                metrics_of_items: Callable[[DataFrame], DataFrame] = item_metrics) -> DataFrame:
    o = stg_orders
    joined = (o.join(metrics_of_items(stg_order_items), "order_id", "left")
               .join(payment_metrics(stg_order_payments), "order_id", "left")
               .join(review_metrics(stg_order_reviews), "order_id", "left"))
    delivered, estimated = F.col("delivered_to_customer_at"), F.col("estimated_delivery_at")
    zero = F.lit(0)
    return joined.select(
        "order_id",
        F.col("customer_id").alias("customer_key"),
        date_key("purchased_at").alias("order_date_key"),
        "order_status", "purchased_at", "approved_at", "delivered_to_carrier_at",
        "delivered_to_customer_at", "estimated_delivery_at",
        F.coalesce("item_count", zero.cast("bigint")).alias("item_count"),
        F.coalesce("distinct_product_count", zero.cast("bigint")).alias("distinct_product_count"),
        F.coalesce("distinct_seller_count", zero.cast("bigint")).alias("distinct_seller_count"),
        F.coalesce("item_value", zero).cast(MONEY).alias("item_value"),
        F.coalesce("freight_value", zero).cast(MONEY).alias("freight_value"),
        F.coalesce("payment_count", zero.cast("bigint")).alias("payment_count"),
        F.coalesce("payment_value", zero).cast(MONEY).alias("payment_value"),
        "max_payment_installments",
        F.coalesce("review_count", zero.cast("bigint")).alias("review_count"),
        "average_review_score",
        days_between("purchased_at", "delivered_to_customer_at").alias("delivery_days"),
        F.when(delivered.isNull(), F.lit(None).cast("boolean"))
         .when(delivered > estimated, F.lit(True))
         .otherwise(F.lit(False)).alias("is_late_delivery"))


def fact_order_items(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    orders = stg_orders.select("order_id", "customer_id", "purchased_at")
    return stg_order_items.join(orders, "order_id", "inner").select(
        "order_id", "order_item_id",
        F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        F.col("seller_id").alias("seller_key"),
        date_key("purchased_at").alias("order_date_key"),
        "shipping_limit_at", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("gross_item_value"))


def daily_sales(fact_orders_df: DataFrame) -> DataFrame:
    return fact_orders_df.groupBy(F.col("order_date_key").alias("date_key")).agg(
        F.countDistinct("customer_key").alias("customer_count"), *_daily_kpis())


def daily_sales_in_two(fact_orders_df: DataFrame) -> DataFrame:
    """``daily_sales`` of the days of a written fact, which can be read twice:
    the customers are counted apart, so that no more than they and their days
    is shuffled by the order."""
    by_day = fact_orders_df.groupBy(F.col("order_date_key").alias("date_key"))
    return by_day.agg(*_daily_kpis()).join(
        by_day.agg(F.countDistinct("customer_key").alias("customer_count")), "date_key")


def _daily_kpis() -> list[Column]:
    return [
        F.count("order_id").alias("order_count"),
        F.count_if(F.col("order_status") == "delivered").alias("delivered_order_count"),
        F.sum("item_count").alias("item_count"),
        F.sum("item_value").cast(MONEY_SUM).alias("item_value"),
        F.sum("freight_value").cast(MONEY_SUM).alias("freight_value"),
        F.sum("payment_value").cast(MONEY_SUM).alias("payment_value"),
        F.avg("average_review_score").alias("average_review_score"),
        F.avg("delivery_days").alias("average_delivery_days"),
        F.count_if(F.col("is_late_delivery")).alias("late_delivery_count")]


def mart_daily_sales(dim_date_df: DataFrame, fact_orders_df: DataFrame,
                     by_day: Callable[[DataFrame], DataFrame] = daily_sales) -> DataFrame:
    """Daily KPIs for days that have orders.

    The fact is aggregated to the day first (map-side partial aggregation, a
    narrow integer shuffle key; the distinct customer count goes through the
    usual two-level plan on (day, customer)), then joined to the calendar.
    Both sides are one row per day.  Orders without a purchase time have no
    day and are dropped by the inner join, as in the source model.
    """
    daily = by_day(fact_orders_df)
    dates = dim_date_df.select("date_key", "date_day", "year_number", "month_number")
    return daily.join(dates, "date_key", "inner").select(
        "date_key", "date_day", "year_number", "month_number", "order_count",
        "customer_count", "delivered_order_count", "item_count", "item_value",
        "freight_value", "payment_value", "average_review_score", "average_delivery_days",
        "late_delivery_count")
