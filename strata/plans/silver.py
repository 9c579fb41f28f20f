"""Silver layer: typed, cleaned, deduplicated tables (one function per table).

Every function takes the raw (all-string + lineage) Bronze DataFrame and returns
the Silver DataFrame lazily.  Dedup ranks on the *raw* key before cleaning, so
keys that differ only by surrounding blanks stay apart, as in the source
models; the ``unique`` checks in ``plans.suite`` catch such pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.clean import (blank_to_null, lower_code, parse_decimal,
                                    parse_double, parse_int, parse_timestamp,
                                    upper_code, zip5)
from strata.operators.dedup import latest_by
from strata.sources.contracts import LOADED_AT, SOURCE_ROW, contract


def _latest(raw: DataFrame, table: str) -> DataFrame:
    return latest_by(raw, contract(table).key)


# The cleaned order id beside the raw one: a staged order table lies in buckets of it.
ORDER = "_order"


def typed(raw: DataFrame, table: str) -> DataFrame:
    """The raw key columns and the lineage of an order table, and its other
    columns parsed."""
    return raw.select(*contract(table).key, *[parse(column).alias(name) for name, (parse, column) in TYPED[table].items()],
                      LOADED_AT, SOURCE_ROW)


def with_order(rows: DataFrame) -> DataFrame:
    return rows.withColumn(ORDER, blank_to_null("order_id"))


def _latest_typed(raw: DataFrame, table: str) -> DataFrame:
    """As ``_latest``, of the ``typed`` rows: they are parsed before the dedup, so
    that their values and not their texts are shuffled and sorted.  Rows that
    come typed and with the cleaned order id (``with_order``) are grouped by it
    first, which their raw key determines: where they lie in buckets of it,
    nothing is shuffled."""
    key = contract(table).key
    return latest_by(raw, (ORDER, *key)) if ORDER in raw.columns else latest_by(typed(raw, table), key)


def stg_customers(raw: DataFrame) -> DataFrame:
    return _latest(raw, "raw_customers").select(
        blank_to_null("customer_id").alias("customer_id"),
        blank_to_null("customer_unique_id").alias("customer_unique_id"),
        zip5("customer_zip_code_prefix").alias("zip_code_prefix"),
        blank_to_null("customer_city").alias("city"),
        upper_code("customer_state").alias("state_code"),
        F.col(LOADED_AT))


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One representative row per ZIP prefix from independent aggregates.

    Repeated points weigh in the means, and the minimum city and state may come
    from different rows.  All aggregates are partial (map-side), so a hot ZIP
    is pre-reduced before the shuffle.
    """
    typed = raw.where(blank_to_null("geolocation_zip_code_prefix").isNotNull()).select(
        zip5("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        parse_double("geolocation_lat").alias("latitude"),
        parse_double("geolocation_lng").alias("longitude"),
        blank_to_null("geolocation_city").alias("city"),
        upper_code("geolocation_state").alias("state_code"),
        F.col(LOADED_AT))
    return typed.groupBy("zip_code_prefix").agg(
        F.min("city").alias("city"),
        F.min("state_code").alias("state_code"),
        F.avg("latitude").alias("latitude"),
        F.avg("longitude").alias("longitude"),
        F.max(LOADED_AT).alias(LOADED_AT))


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _latest_typed(raw, "raw_order_items").select(
        blank_to_null("order_id").alias("order_id"),
        parse_int("order_item_id").alias("order_item_id"),
        "product_id", "seller_id", "shipping_limit_at", "price", "freight_value", LOADED_AT)


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return _latest_typed(raw, "raw_order_payments").select(
        blank_to_null("order_id").alias("order_id"),
        parse_int("payment_sequential").alias("payment_sequential"),
        "payment_type", "payment_installments", "payment_value", LOADED_AT)


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return _latest_typed(raw, "raw_order_reviews").select(
        blank_to_null("review_id").alias("review_id"),
        blank_to_null("order_id").alias("order_id"),
        "review_score", "review_comment_title", "review_comment_message", "review_created_at",
        "review_answered_at", LOADED_AT)


def stg_orders(raw: DataFrame) -> DataFrame:
    return _latest_typed(raw, "raw_orders").select(
        blank_to_null("order_id").alias("order_id"),
        "customer_id", "order_status", "purchased_at", "approved_at", "delivered_to_carrier_at",
        "delivered_to_customer_at", "estimated_delivery_at", LOADED_AT)


def stg_products(raw: DataFrame) -> DataFrame:
    return _latest(raw, "raw_products").select(
        blank_to_null("product_id").alias("product_id"),
        blank_to_null("product_category_name").alias("category_name"),
        parse_int("product_name_lenght").alias("name_length"),
        parse_int("product_description_lenght").alias("description_length"),
        parse_int("product_photos_qty").alias("photos_quantity"),
        parse_decimal("product_weight_g").alias("weight_g"),
        parse_decimal("product_length_cm").alias("length_cm"),
        parse_decimal("product_height_cm").alias("height_cm"),
        parse_decimal("product_width_cm").alias("width_cm"),
        F.col(LOADED_AT))


def stg_sellers(raw: DataFrame) -> DataFrame:
    return _latest(raw, "raw_sellers").select(
        blank_to_null("seller_id").alias("seller_id"),
        zip5("seller_zip_code_prefix").alias("zip_code_prefix"),
        blank_to_null("seller_city").alias("city"),
        upper_code("seller_state").alias("state_code"),
        F.col(LOADED_AT))


def stg_product_categories(raw: DataFrame) -> DataFrame:
    return _latest(raw, "raw_product_category_translation").select(
        blank_to_null("product_category_name").alias("category_name"),
        blank_to_null("product_category_name_english").alias("category_name_english"),
        F.col(LOADED_AT))


# Order table -> Silver column: (parser, raw column), but for the raw key's columns.
TYPED = {
    "raw_order_items": {"product_id": (blank_to_null, "product_id"), "seller_id": (blank_to_null, "seller_id"),
                        "shipping_limit_at": (parse_timestamp, "shipping_limit_date"),
                        "price": (parse_decimal, "price"), "freight_value": (parse_decimal, "freight_value")},
    "raw_order_payments": {"payment_type": (lower_code, "payment_type"),
                           "payment_installments": (parse_int, "payment_installments"),
                           "payment_value": (parse_decimal, "payment_value")},
    "raw_order_reviews": {"review_score": (parse_int, "review_score"),
                          "review_comment_title": (blank_to_null, "review_comment_title"),
                          "review_comment_message": (blank_to_null, "review_comment_message"),
                          "review_created_at": (parse_timestamp, "review_creation_date"),
                          "review_answered_at": (parse_timestamp, "review_answer_timestamp")},
    "raw_orders": {"customer_id": (blank_to_null, "customer_id"), "order_status": (lower_code, "order_status"),
                   "purchased_at": (parse_timestamp, "order_purchase_timestamp"),
                   "approved_at": (parse_timestamp, "order_approved_at"),
                   "delivered_to_carrier_at": (parse_timestamp, "order_delivered_carrier_date"),
                   "delivered_to_customer_at": (parse_timestamp, "order_delivered_customer_date"),
                   "estimated_delivery_at": (parse_timestamp, "order_estimated_delivery_date")},
}

# Silver table -> (builder, Bronze input)
MODELS = {
    "stg_customers": (stg_customers, "raw_customers"),
    "stg_geolocation": (stg_geolocation, "raw_geolocation"),
    "stg_order_items": (stg_order_items, "raw_order_items"),
    "stg_order_payments": (stg_order_payments, "raw_order_payments"),
    "stg_order_reviews": (stg_order_reviews, "raw_order_reviews"),
    "stg_orders": (stg_orders, "raw_orders"),
    "stg_products": (stg_products, "raw_products"),
    "stg_sellers": (stg_sellers, "raw_sellers"),
    "stg_product_categories": (stg_product_categories, "raw_product_category_translation"),
}


# Raw columns that Silver parses, per Bronze table (for the parse-failure report).
PARSED = {
    "raw_geolocation": {"geolocation_lat": parse_double, "geolocation_lng": parse_double},
    "raw_order_items": {"order_item_id": parse_int, "shipping_limit_date": parse_timestamp,
                        "price": parse_decimal, "freight_value": parse_decimal},
    "raw_order_payments": {"payment_sequential": parse_int, "payment_installments": parse_int,
                           "payment_value": parse_decimal},
    "raw_order_reviews": {"review_score": parse_int, "review_creation_date": parse_timestamp,
                          "review_answer_timestamp": parse_timestamp},
    "raw_orders": {"order_purchase_timestamp": parse_timestamp,
                   "order_approved_at": parse_timestamp,
                   "order_delivered_carrier_date": parse_timestamp,
                   "order_delivered_customer_date": parse_timestamp,
                   "order_estimated_delivery_date": parse_timestamp},
    "raw_products": {"product_name_lenght": parse_int, "product_description_lenght": parse_int,
                     "product_photos_qty": parse_int, "product_weight_g": parse_decimal,
                     "product_length_cm": parse_decimal, "product_height_cm": parse_decimal,
                     "product_width_cm": parse_decimal},
}
