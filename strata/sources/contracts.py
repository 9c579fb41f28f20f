"""Dataset contracts: the nine landing datasets, their exact column order, their
dedup keys and the lineage columns every Bronze table carries.

A contract binds CSV columns by position to an all-string schema; the header
must equal the column list exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (LongType, StringType, StructField, StructType,
                               TimestampType)

LOAD_ID = "_load_id"
SOURCE_FILE = "_source_file"
SOURCE_ROW = "_source_row_number"
LOADED_AT = "_loaded_at"
LINEAGE_COLUMNS = (LOAD_ID, SOURCE_FILE, SOURCE_ROW, LOADED_AT)


@dataclass(frozen=True)
class Contract:
    name: str                      # Bronze table name
    columns: tuple[str, ...]       # CSV header, in order
    key: tuple[str, ...] = ()      # dedup key on raw values (empty: grouped, not deduped)
    description: str = ""
    filename: str = ""             # landing file name; defaults to <name>.csv
    not_null: tuple[str, ...] = field(default=())
    unique: tuple[str, ...] = field(default=())

    @property
    def file(self) -> str:
        return self.filename or f"{self.name}.csv"

    def csv_schema(self) -> StructType:
        return StructType([StructField(c, StringType(), True) for c in self.columns])

    def bronze_schema(self) -> StructType:
        return StructType(
            [StructField(c, StringType(), True,
                         metadata={"comment": f"{self.name}.{c}: raw text from {self.file}, "
                                              f"column {i + 1}"})
             for i, c in enumerate(self.columns)]
            + [StructField(LOAD_ID, StringType(), False),
               StructField(SOURCE_FILE, StringType(), False),
               StructField(SOURCE_ROW, LongType(), False),
               StructField(LOADED_AT, TimestampType(), False)])


# Dataset names, column lists (in file order, including the two
# misspelt product columns, which belong to the landing contract), raw dedup
# keys and the Bronze-level not_null / unique tests.
CONTRACTS: tuple[Contract, ...] = (
    Contract("raw_customers",
             ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
              "customer_city", "customer_state"),
             key=("customer_id",), description="Customers as extracted.",
             not_null=("customer_id", "customer_unique_id"), unique=("customer_id",)),
    Contract("raw_geolocation",
             ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
              "geolocation_city", "geolocation_state"),
             description="ZIP prefix coordinates; many rows per prefix.",
             not_null=("geolocation_zip_code_prefix",)),
    Contract("raw_order_items",
             ("order_id", "order_item_id", "product_id", "seller_id",
              "shipping_limit_date", "price", "freight_value"),
             key=("order_id", "order_item_id"), description="Order lines.",
             not_null=("order_id", "order_item_id", "product_id", "seller_id")),
    Contract("raw_order_payments",
             ("order_id", "payment_sequential", "payment_type",
              "payment_installments", "payment_value"),
             key=("order_id", "payment_sequential"), description="Payments.",
             not_null=("order_id",)),
    Contract("raw_order_reviews",
             ("review_id", "order_id", "review_score", "review_comment_title",
              "review_comment_message", "review_creation_date",
              "review_answer_timestamp"),
             key=("review_id", "order_id"), description="Reviews.",
             not_null=("review_id", "order_id")),
    Contract("raw_orders",
             ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
              "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"),
             key=("order_id",), description="Orders and their lifecycle.",
             not_null=("order_id", "customer_id"), unique=("order_id",)),
    Contract("raw_products",
             ("product_id", "product_category_name", "product_name_lenght",
              "product_description_lenght", "product_photos_qty", "product_weight_g",
              "product_length_cm", "product_height_cm", "product_width_cm"),
             key=("product_id",), description="Products.",
             not_null=("product_id",), unique=("product_id",)),
    Contract("raw_sellers",
             ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
             key=("seller_id",), description="Sellers.",
             not_null=("seller_id",), unique=("seller_id",)),
    Contract("raw_product_category_translation",
             ("product_category_name", "product_category_name_english"),
             key=("product_category_name",), description="Category translations.",
             not_null=("product_category_name",), unique=("product_category_name",)),
)

BY_NAME: dict[str, Contract] = {c.name: c for c in CONTRACTS}


def contract(name: str) -> Contract:
    return BY_NAME[name]
