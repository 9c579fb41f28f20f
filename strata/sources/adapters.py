"""Bronze-shaped views over the driver's test tables.

The landing CSVs are not available here, so each raw table is derived from the
TPC-H-like parquet tables: every business column is a string, the lineage
columns are present, and the values carry the dirt the Silver layer must clean
(surrounding blanks, NULL tokens, unparsable numbers and dates, blank ZIPs,
duplicate keys with a total tie-break order, deliveries before purchase).

Every row of every input table is used; the derived tables grow with the input.
The landing rule (empty string and NULL tokens become NULL) is applied to every
business column, exactly as the CSV ingest does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.clean import null_tokens
from strata.sources.contracts import CONTRACTS, LOADED_AT, SOURCE_ROW, Contract, contract

LOAD_TIME = dt.datetime(2024, 1, 1, 0, 0, 0)
# Row numbers from (part, supplier): supplier keys stay below the step.
PART_STEP = 1 << 31


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _day(c: str, offset) -> Column:
    """Date string of timestamp column ``c`` shifted by ``offset`` days."""
    return F.date_add(F.to_date(F.col(c)), offset).cast("string")


def _bronze(df: DataFrame, table: str, loaded_at: Column, row_number: Column) -> DataFrame:
    cols = contract(table).columns
    return df.select(*[null_tokens(F.col(c)).alias(c) for c in cols],
                     loaded_at.cast("timestamp").alias(LOADED_AT),
                     row_number.cast("bigint").alias(SOURCE_ROW))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("DELIVERED"))
               .when(F.col("o_orderstatus") == "O", F.lit(" shipped"))
               .otherwise(F.lit("Processing ")))
    approved = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")) \
                .otherwise(F.concat(_day("o_orderdate", 0), F.lit(" 09:30:00")))
    carrier = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("not-a-date")) \
               .otherwise(F.concat(_day("o_orderdate", 2), F.lit(" 08:00:00")))
    customer = F.when(F.col("o_orderstatus") == "F",
                      F.concat(_day("o_orderdate", (F.col("o_orderkey") % 41 - 1).cast("int")),
                               F.lit(" 12:00:00"))).otherwise(F.lit(""))
    estimate = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("NULL")) \
                .otherwise(F.concat(_day("o_orderdate", 20), F.lit(" 00:00:00")))
    shaped = o.select(
        F.concat(F.lit(" "), _s("o_orderkey")).alias("order_id"),
        F.concat(_s("o_custkey"), F.lit(" ")).alias("customer_id"),
        status.alias("order_status"),
        _s("o_orderdate").alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        customer.alias("order_delivered_customer_date"),
        estimate.alias("order_estimated_delivery_date"),
        F.col("o_orderkey"))
    return _bronze(shaped, "raw_orders", F.lit(LOAD_TIME), F.col("o_orderkey") + 1)


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; (order, line) repeats in the input, so dedup is exercised.
    Load time and row number (part, supplier) order the copies totally."""
    li = _read(spark, sf_dir, "lineitem")
    # Open lines carry a leading blank in the order id: copies of one line then
    # differ only by that blank, survive the raw-key dedup and surface in the
    # composite unique check, as they would in the source system.
    order_id = F.when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), _s("l_orderkey"))) \
                .otherwise(_s("l_orderkey"))
    shaped = li.select(
        order_id.alias("order_id"),
        _s("l_linenumber").alias("order_item_id"),
        _s("l_partkey").alias("product_id"),
        _s("l_suppkey").alias("seller_id"),
        _s("l_shipdate").alias("shipping_limit_date"),
        _s(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        _s(F.col("l_quantity").cast("decimal(18,2)")).alias("freight_value"),
        "l_shipdate", "l_partkey", "l_suppkey")
    return _bronze(shaped, "raw_order_items", F.col("l_shipdate"),
                   F.col("l_partkey") * PART_STEP + F.col("l_suppkey"))


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order line: several payments per order, repeated
    (order, sequence) pairs, unparsable amounts on returned open lines, and
    chargebacks that make some orders' totals negative."""
    li = _read(spark, sf_dir, "lineitem")
    ptype = (F.when(F.col("l_returnflag") == "N", F.lit("CREDIT_CARD"))
              .when(F.col("l_returnflag") == "A", F.lit(" Boleto"))
              .otherwise(F.lit("voucher ")))
    value = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.lit("n/a")) \
             .when(F.col("l_partkey") % 97 == 0, F.lit("-999999.00")) \
             .otherwise(_s(F.col("l_extendedprice").cast("decimal(18,2)")))
    shaped = li.select(
        F.concat(F.lit(" "), _s("l_orderkey")).alias("order_id"),
        _s("l_linenumber").alias("payment_sequential"),
        ptype.alias("payment_type"),
        _s(F.col("l_quantity").cast("bigint") % 10 + 1).alias("payment_installments"),
        value.alias("payment_value"),
        "l_shipdate", "l_partkey", "l_suppkey")
    return _bronze(shaped, "raw_order_payments", F.col("l_shipdate"),
                   F.col("l_partkey") * PART_STEP + F.col("l_suppkey"))


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order; those of pending orders have no score yet, and
    score 0 is out of the accepted range."""
    o = _read(spark, sf_dir, "orders")
    answered = F.when(F.col("o_orderstatus") == "F",
                      F.concat(_day("o_orderdate", 4), F.lit(" 10:00:00"))).otherwise(F.lit(""))
    shaped = o.select(
        F.concat(F.lit("r"), _s("o_orderkey")).alias("review_id"),
        F.concat(F.lit(" "), _s("o_orderkey")).alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(_s(F.col("o_custkey") % 6))
         .alias("review_score"),
        F.lit("  ").alias("review_comment_title"),
        F.col("o_orderpriority").alias("review_comment_message"),
        _day("o_orderdate", 3).alias("review_creation_date"),
        answered.alias("review_answer_timestamp"),
        "o_orderkey")
    return _bronze(shaped, "raw_order_reviews", F.lit(LOAD_TIME), F.col("o_orderkey") + 1)


def _regional(df: DataFrame, spark: SparkSession, sf_dir: str, nation_key: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    return (df.join(nation, df[nation_key] == nation["n_nationkey"], "inner")
              .join(region, F.col("n_regionkey") == region["r_regionkey"], "inner"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with ZIP = nation * 37; building-segment customers use a ZIP
    no other source has, those of the machinery segment one of seven digits;
    every 50th ZIP is blank.  Some customers arrive twice: every 40th with a
    blank before its id, the next with the same id on a later row."""
    c = _regional(_read(spark, sf_dir, "customer"), spark, sf_dir, "c_nationkey")
    zip_code = (F.when(F.col("c_custkey") % 50 == 0, F.lit(" "))
                 .when(F.col("c_mktsegment") == "BUILDING", _s(F.col("c_nationkey") * 37 + 2))
                 .when(F.col("c_mktsegment") == "MACHINERY", _s(F.col("c_nationkey") + 1234500))
                 .otherwise(_s(F.col("c_nationkey") * 37)))
    shaped = c.select(
        _s("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        zip_code.alias("customer_zip_code_prefix"),
        F.concat(F.lit("  "), F.col("n_name")).alias("customer_city"),
        F.lower("r_name").alias("customer_state"),
        "c_custkey")
    again = F.when(F.col("c_custkey") % 40 < 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    twice = shaped.withColumn("copy", F.explode(again)).withColumn(
        "customer_id", F.when((F.col("copy") == 1) & (F.col("c_custkey") % 40 == 0),
                              F.concat(F.lit(" "), "customer_id")).otherwise(F.col("customer_id")))
    return _bronze(twice, "raw_customers", F.lit(LOAD_TIME),
                   F.col("c_custkey") + 1 + F.col("copy") * PART_STEP)


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers; odd supplier keys sit in a ZIP only sellers have."""
    s = _regional(_read(spark, sf_dir, "supplier"), spark, sf_dir, "s_nationkey")
    shaped = s.select(
        _s("s_suppkey").alias("seller_id"),
        _s(F.col("s_nationkey") * 37 + F.col("s_suppkey") % 2).alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.upper("r_name").alias("seller_state"),
        "s_suppkey")
    return _bronze(shaped, "raw_sellers", F.lit(LOAD_TIME), F.col("s_suppkey") + 1)


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One coordinate per supplier, at its nation's ZIP: many points per ZIP
    (so the means are exercised), some unparsable latitudes."""
    s = _regional(_read(spark, sf_dir, "supplier"), spark, sf_dir, "s_nationkey")
    lat = F.when(F.col("s_suppkey") % 7 == 0, F.lit("x")) \
           .otherwise(F.concat(_s(F.col("s_suppkey") % 90 - 45), F.lit(".25")))
    lng = F.concat(F.lit("-"), _s(F.col("s_suppkey") % 45), F.lit(".5"))
    shaped = s.select(
        _s(F.col("s_nationkey") * 37).alias("geolocation_zip_code_prefix"),
        lat.alias("geolocation_lat"), lng.alias("geolocation_lng"),
        F.lower(F.col("n_name")).alias("geolocation_city"),
        F.lower("r_name").alias("geolocation_state"),
        "s_suppkey")
    return _bronze(shaped, "raw_geolocation", F.lit(LOAD_TIME), F.col("s_suppkey") + 1)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products: some without category, half-unit lengths (rounded), missing widths."""
    p = _read(spark, sf_dir, "part")
    shaped = p.select(
        _s("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 25 == 0, F.lit("")).otherwise(F.lower("p_type"))
         .alias("product_category_name"),
        _s(F.length("p_name")).alias("product_name_lenght"),
        F.concat(_s("p_size"), F.lit(".5")).alias("product_description_lenght"),
        F.lit("1").alias("product_photos_qty"),
        _s(F.col("p_retailprice").cast("decimal(18,2)")).alias("product_weight_g"),
        _s("p_size").alias("product_length_cm"),
        F.lit("2.50").alias("product_height_cm"),
        F.when(F.col("p_partkey") % 9 == 0, F.lit("")).otherwise(F.lit("3"))
         .alias("product_width_cm"),
        "p_partkey")
    return _bronze(shaped, "raw_products", F.lit(LOAD_TIME), F.col("p_partkey") + 1)


def raw_product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every product type; the promotional one has no translation."""
    p = _read(spark, sf_dir, "part")
    shaped = (p.select(F.lower("p_type").alias("product_category_name"),
                       F.when(F.col("p_type") != "PROMO", F.concat("p_type", F.lit("_EN")))
                        .alias("product_category_name_english"))
               .distinct())
    return _bronze(shaped, "raw_product_category_translation", F.lit(LOAD_TIME), F.lit(1))


def raw_orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load of the orders extract: every order still open in the first
    load arrives again, now delivered ten days after purchase."""
    o = _read(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    shaped = raw_orders(spark, sf_dir).join(
        o.select(F.concat(F.lit(" "), _s("o_orderkey")).alias("order_id"), "o_orderdate"),
        "order_id", "inner")
    return shaped.select(
        "order_id", "customer_id", F.lit("DELIVERED").alias("order_status"),
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        F.concat(_day("o_orderdate", 10), F.lit(" 18:00:00")).alias("order_delivered_customer_date"),
        "order_estimated_delivery_date",
        F.lit(dt.datetime(2024, 1, 2)).cast("timestamp").alias(LOADED_AT),
        F.col(SOURCE_ROW))


def raw_orders_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that corrects the orders bought in March 1998: all are delivered,
    some were bought 40 days later, and some lose their purchase time."""
    bought = F.to_date("o_orderdate")
    o = (_read(spark, sf_dir, "orders").where(bought.between("1998-03-01", "1998-03-31"))
         .select(F.concat(F.lit(" "), _s("o_orderkey")).alias("order_id"), "o_orderkey", "o_orderdate"))
    again = (F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string"))
              .when(F.col("o_orderkey") % 3 == 0, F.concat(_day("o_orderdate", 40), F.lit(" 00:00:00")))
              .otherwise(F.col("order_purchase_timestamp")))
    return raw_orders(spark, sf_dir).join(o, "order_id").select(
        "order_id", "customer_id", F.lit("DELIVERED").alias("order_status"),
        again.alias("order_purchase_timestamp"), "order_approved_at", "order_delivered_carrier_date",
        F.concat(_day("o_orderdate", 12), F.lit(" 18:00:00")).alias("order_delivered_customer_date"),
        "order_estimated_delivery_date",
        F.lit(dt.datetime(2024, 1, 3)).cast("timestamp").alias(LOADED_AT), F.col(SOURCE_ROW))


BUILDERS = {
    "raw_customers": raw_customers,
    "raw_geolocation": raw_geolocation,
    "raw_order_items": raw_order_items,
    "raw_order_payments": raw_order_payments,
    "raw_order_reviews": raw_order_reviews,
    "raw_orders": raw_orders,
    "raw_products": raw_products,
    "raw_sellers": raw_sellers,
    "raw_product_category_translation": raw_product_category_translation,
}
assert set(BUILDERS) == {c.name for c in CONTRACTS}


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return BUILDERS[table](spark, sf_dir)


class Bronze:
    """Lazy accessor: ``Bronze(spark, dir)["raw_orders"]``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, table: str) -> DataFrame:
        return bronze(self.spark, self.sf_dir, table)


# Landing files -----------------------------------------------------------------
def landing_from_frames(frames: Mapping[str, DataFrame], landing_dir: str,
                        contracts: Iterable[Contract] = CONTRACTS,
                        files_per_dataset: int | None = None,
                        mode: str = "errorifexists") -> None:
    """Write all-string frames as landing CSVs (a directory of part files per
    dataset, header in each), in the exact format ``read_strict`` expects."""
    for c in contracts:
        df = frames[c.name].select(*c.columns)
        if files_per_dataset:
            df = df.repartition(files_per_dataset)
        (df.write.mode(mode)
           .option("header", True).option("quote", '"').option("escape", '"')
           .option("quoteAll", False).option("nullValue", "")
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
           .option("encoding", "UTF-8")
           .csv(f"{landing_dir.rstrip('/')}/{c.file}"))


def land_lines(lines: DataFrame, path: str, c: Contract, mode: str = "errorifexists") -> None:
    """Lines of text as landing files of a contract, its header in each."""
    (lines.toDF(",".join(c.columns)).write.mode(mode).option("header", True)
     .option("sep", "\u0001").option("quote", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def land_files(lines: DataFrame, path: str, c: Contract) -> None:
    """``lines`` (part, row, value) as landing files of a contract, one for each
    part, in the folder part=..: its header, then the values by row, bytes as
    they are (so none may need quotes)."""
    header = lines.select("part").distinct().select(
        "part", F.lit(-1).cast("bigint").alias("row"), F.lit(",".join(c.columns)).alias("value"))
    (lines.select("part", F.col("row").cast("bigint").alias("row"), "value").unionByName(header)
     .repartition("part").sortWithinPartitions("part", "row")
     .select("part", "value").write.partitionBy("part").text(path))


def land_rows(rows: DataFrame, path: str, c: Contract, part: Column) -> None:
    """Raw rows as landing files, one for each ``part``, by their row numbers."""
    value = F.concat_ws(",", *[F.coalesce(x, F.lit("")) for x in c.columns])
    land_files(rows.select(part.alias("part"), F.col(SOURCE_ROW).alias("row"), value.alias("value")), path, c)
