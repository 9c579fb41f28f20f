"""Hand-made micro fixtures, one per semantic trap of the source models."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.operators import calendar as cal
from strata.plans import gold as g
from strata.plans import silver as s
from strata.sources.contracts import contract

T0 = dt.datetime(2024, 1, 1)


def raw(spark, table, rows, loaded=T0):
    """Rows of business values (dicts) -> Bronze frame with lineage."""
    cols = contract(table).columns
    data = []
    for i, r in enumerate(rows, start=1):
        data.append(tuple(r.get(c) for c in cols) + (r.get("_loaded_at", loaded),
                                                     r.get("_source_row_number", i)))
    schema = ", ".join(f"{c} string" for c in cols) + ", _loaded_at timestamp, _source_row_number bigint"
    return spark.createDataFrame(data, schema)


def test_dedup_last_file_row_wins(spark):
    df = raw(spark, "raw_orders", [{"order_id": "o1", "customer_id": "a"},
                                   {"order_id": "o1", "customer_id": "b"}])
    out = s.stg_orders(df).collect()
    assert [(r.order_id, r.customer_id) for r in out] == [("o1", "b")]


def test_dedup_newest_load_wins_over_row_number(spark):
    df = raw(spark, "raw_orders", [
        {"order_id": "o1", "customer_id": "new", "_loaded_at": dt.datetime(2024, 2, 1),
         "_source_row_number": 1},
        {"order_id": "o1", "customer_id": "old", "_source_row_number": 9}])
    assert s.stg_orders(df).collect()[0].customer_id == "new"


def test_dedup_on_raw_key_keeps_blank_variants(spark):
    df = raw(spark, "raw_customers", [{"customer_id": " a", "customer_unique_id": "u"},
                                      {"customer_id": "a", "customer_unique_id": "u"}])
    out = s.stg_customers(df)
    assert sorted(r.customer_id for r in out.collect()) == ["a", "a"]
    from strata.operators.quality import unique
    assert unique(out, "customer_id").collect()[0].n_records == 2


def test_dedup_null_keys_collapse(spark):
    df = raw(spark, "raw_orders", [{"order_id": None, "customer_id": str(i)} for i in range(3)])
    out = s.stg_orders(df).collect()
    assert len(out) == 1 and out[0].customer_id == "2"


def test_item_keys_dedup_on_raw_strings(spark):
    df = raw(spark, "raw_order_items", [
        {"order_id": "o", "order_item_id": "1", "price": "1"},
        {"order_id": "o", "order_item_id": "01", "price": "2"}])
    out = s.stg_order_items(df).collect()
    assert sorted(r.order_item_id for r in out) == [1, 1]


def test_null_tokens(spark):
    df = spark.createDataFrame([("",), ("NULL",), ("null",), ("x",), (None,), (" ",)], "v string")
    got = [r[0] for r in df.select(C.null_tokens("v")).collect()]
    assert got == [None, None, None, "x", None, " "]


def test_number_parsing(spark):
    df = spark.createDataFrame([("12.5",), ("-12.5",), (" 7 ",), ("1e2",), ("abc",), (None,)],
                               "v string")
    assert [r[0] for r in df.select(C.parse_int("v")).collect()] == [13, -13, 7, 100, None, None]


def test_decimal_parsing(spark):
    df = spark.createDataFrame([("1.005",), ("12345678901234567890",)], "v string")
    assert [r[0] for r in df.select(C.parse_decimal("v")).collect()] == [Decimal("1.01"), None]


def test_timestamp_parsing(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("bad",), (None,)], "v string")
    assert [r[0] for r in df.select(C.parse_timestamp("v")).collect()] == [
        dt.datetime(2017, 10, 2, 10, 56, 33), None, None]


def test_zip_is_padded_and_never_cut(spark):
    df = spark.createDataFrame([("1",), ("123456",), ("  ",)], "v string")
    assert [r[0] for r in df.select(C.zip5("v")).collect()] == ["00001", "123456", None]


def _orders(spark, rows):
    return s.stg_orders(raw(spark, "raw_orders", rows))


def _empty(spark, table):
    return raw(spark, table, [])


def _fact(spark, orders, items=(), payments=(), reviews=()):
    return g.fact_orders(_orders(spark, orders),
                         s.stg_order_items(raw(spark, "raw_order_items", list(items))),
                         s.stg_order_payments(raw(spark, "raw_order_payments", list(payments))),
                         s.stg_order_reviews(raw(spark, "raw_order_reviews", list(reviews))))


def test_delivery_days_count_midnights(spark):
    f = _fact(spark, [{"order_id": "o", "customer_id": "c",
                       "order_purchase_timestamp": "2020-01-01 23:59:59",
                       "order_delivered_customer_date": "2020-01-02 00:00:01"}])
    assert f.collect()[0].delivery_days == 1


def test_late_delivery_flag(spark):
    base = {"customer_id": "c", "order_purchase_timestamp": "2020-01-01 00:00:00"}
    f = _fact(spark, [
        dict(base, order_id="late", order_delivered_customer_date="2020-01-10 00:00:00",
             order_estimated_delivery_date="2020-01-05 00:00:00"),
        dict(base, order_id="early", order_delivered_customer_date="2020-01-03 00:00:00",
             order_estimated_delivery_date="2020-01-05 00:00:00"),
        dict(base, order_id="noest", order_delivered_customer_date="2020-01-03 00:00:00"),
        dict(base, order_id="open")])
    got = {r.order_id: r.is_late_delivery for r in f.collect()}
    assert got == {"late": True, "early": False, "noest": False, "open": None}


def test_fanout_is_not_multiplied(spark):
    o = [{"order_id": "o", "customer_id": "c"}]
    items = [{"order_id": "o", "order_item_id": str(i), "product_id": "p", "seller_id": "s",
              "price": "10.00", "freight_value": "1.00"} for i in (1, 2)]
    pays = [{"order_id": "o", "payment_sequential": str(i), "payment_value": "7.00",
             "payment_installments": str(i)} for i in (1, 2, 3)]
    revs = [{"review_id": f"r{i}", "order_id": "o", "review_score": str(i)} for i in (3, 4)]
    r = _fact(spark, o, items, pays, revs).collect()[0]
    assert (r.item_count, r.item_value, r.freight_value) == (2, Decimal("20.00"), Decimal("2.00"))
    assert (r.payment_count, r.payment_value, r.max_payment_installments) == (3, Decimal("21.00"), 3)
    assert (r.review_count, r.average_review_score) == (2, 3.5)
    assert (r.distinct_product_count, r.distinct_seller_count) == (1, 1)


def test_childless_order_defaults(spark):
    r = _fact(spark, [{"order_id": "o", "customer_id": "c"}]).collect()[0]
    assert (r.item_count, r.item_value, r.payment_count, r.payment_value, r.review_count) == (
        0, Decimal("0.00"), 0, Decimal("0.00"), 0)
    assert r.average_review_score is None and r.max_payment_installments is None


def test_review_mean_of_means_in_mart(spark):
    base = {"customer_id": "c", "order_purchase_timestamp": "2020-01-01 10:00:00"}
    orders = [dict(base, order_id="a"), dict(base, order_id="b")]
    revs = [{"review_id": "1", "order_id": "a", "review_score": "1"},
            {"review_id": "2", "order_id": "a", "review_score": "2"},
            {"review_id": "3", "order_id": "b", "review_score": "5"}]
    fact = _fact(spark, orders, reviews=revs)
    mart = g.mart_daily_sales(g.dim_date(_orders(spark, orders)), fact).collect()[0]
    assert mart.average_review_score == (1.5 + 5) / 2
    assert mart.order_count == 2 and mart.customer_count == 1


def test_orders_without_date_absent_from_mart(spark):
    orders = [{"order_id": "a", "customer_id": "c", "order_purchase_timestamp": "2020-01-01"},
              {"order_id": "b", "customer_id": "c"}]
    fact = _fact(spark, orders)
    assert {r.order_id: r.order_date_key for r in fact.collect()} == {"a": 20200101, "b": None}
    mart = g.mart_daily_sales(g.dim_date(_orders(spark, orders)), fact).collect()
    assert [(r.date_key, r.order_count) for r in mart] == [(20200101, 1)]


def test_calendar_spans_all_orders_and_empty_default(spark):
    far = [{"order_id": "a", "customer_id": "c", "order_purchase_timestamp": "2000-01-01"},
           {"order_id": "b", "customer_id": "c", "order_purchase_timestamp": "2030-01-01"}]
    d = g.dim_date(_orders(spark, far))
    assert d.count() == (dt.date(2030, 1, 1) - dt.date(2000, 1, 1)).days + 1 > 5000
    mart = g.mart_daily_sales(d, _fact(spark, far)).collect()
    assert sorted((r.date_key, r.order_count) for r in mart) == [(20000101, 1), (20300101, 1)]
    empty = g.dim_date(_orders(spark, [{"order_id": "a", "customer_id": "c"}]))
    days = empty.agg(F.min("date_day"), F.max("date_day"), F.count("*")).collect()[0]
    assert (days[0], days[1], days[2]) == (dt.date(2016, 1, 1), dt.date(2018, 12, 31), 1096)


def test_calendar_reversed_bounds_give_no_rows(spark):
    b = spark.createDataFrame([(dt.date(2020, 1, 2), dt.date(2020, 1, 1))], "min_date date, max_date date")
    assert cal.calendar(b).count() == 0


def test_calendar_attributes(spark):
    b = spark.createDataFrame([(dt.date(2021, 1, 1), dt.date(2021, 1, 3))], "min_date date, max_date date")
    r = cal.calendar(b).orderBy("date_day").collect()
    assert (r[0].date_key, r[0].week_of_year, r[0].day_of_week, r[0].day_name, r[0].month_name,
            r[0].quarter_number) == (20210101, 53, 5, "Fri", "Jan", 1)
    assert [x.is_weekend for x in r] == [False, True, True]


def test_geography_priority(spark):
    geo = s.stg_geolocation(raw(spark, "raw_geolocation", [
        {"geolocation_zip_code_prefix": "1", "geolocation_lat": "1.5", "geolocation_lng": "2",
         "geolocation_city": "g"},
        {"geolocation_zip_code_prefix": "1", "geolocation_lat": "2.5", "geolocation_lng": "4",
         "geolocation_city": "h"}]))
    cust = s.stg_customers(raw(spark, "raw_customers", [
        {"customer_id": "c1", "customer_unique_id": "u", "customer_zip_code_prefix": "1",
         "customer_city": "cust"},
        {"customer_id": "c2", "customer_unique_id": "u", "customer_zip_code_prefix": "2",
         "customer_city": "cust"}]))
    sell = s.stg_sellers(raw(spark, "raw_sellers", [
        {"seller_id": "s1", "seller_zip_code_prefix": "2", "seller_city": "sell"},
        {"seller_id": "s2", "seller_zip_code_prefix": "3", "seller_city": "sell"}]))
    out = {r.geography_key: (r.city, r.latitude) for r in g.dim_geography(geo, cust, sell).collect()}
    assert out == {"00001": ("g", 2.0), "00002": ("cust", None), "00003": ("sell", None)}


def test_category_union(spark):
    cats = s.stg_product_categories(raw(spark, "raw_product_category_translation", [
        {"product_category_name": "a", "product_category_name_english": "A"},
        {"product_category_name": "t", "product_category_name_english": "T"}]))
    prods = s.stg_products(raw(spark, "raw_products", [
        {"product_id": "1", "product_category_name": "a"},
        {"product_id": "2", "product_category_name": "p"},
        {"product_id": "3"}]))
    out = {r.category_name: r.category_name_english
           for r in g.dim_product_category(cats, prods).collect()}
    assert out == {"a": "A", "t": "T", "p": None}


def test_volume_and_gross_null_propagation(spark):
    prods = s.stg_products(raw(spark, "raw_products", [
        {"product_id": "1", "product_length_cm": "2", "product_height_cm": "3",
         "product_width_cm": "4"},
        {"product_id": "2", "product_length_cm": "2", "product_height_cm": "3"}]))
    vol = {r.product_key: r.volume_cm3 for r in g.dim_product(prods).collect()}
    assert vol == {"1": Decimal("24.000000"), "2": None}
