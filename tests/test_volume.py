"""What the warehouse's steps shuffle and write: properties that keep the volume down."""

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as q
from strata.plans import catalogue
from strata.sources import csv_ingest as ci
from strata.sources.catalog import Catalog
from strata.sources.contracts import contract

from small_data import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_numbers_come_without_a_shuffle_of_the_rows(spark, tmp_root):
    c = contract("raw_sellers")
    rows = spark.range(600).repartition(3).select(*[F.concat(F.lit(f"{x}-"), "id").alias(x) for x in c.columns])
    rows.write.option("header", True).csv(f"{tmp_root}/in")
    numbered = ci._numbered(spark, c, f"{tmp_root}/in", f"{tmp_root}/staged", False)
    p = plan(numbered)
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p
    files = ci.file_rows(numbered).collect()
    assert len(files) == 3 and sum(r.n for r in files) == 600
    assert all((r.lo, r.hi, r.d) == (1, r.n, r.n) for r in files)


def test_file_rows_finds_repeated_missing_and_null_numbers(spark):
    numbers = {"whole": [*range(1, 201)], "twice": [1, 2, 3, 3, 64, 64, 65], "gap": [1, 2, 4, 128, 129],
               "below": [-65, -64, -1, 0, 0, 1], "null": [None, None], "some": [1, None, 3]}
    rows = [(f, n) for f, own in numbers.items() for n in own]
    df = spark.createDataFrame(rows, f"{ci.SOURCE_FILE} string, {ci.SOURCE_ROW} bigint").repartition(4)
    got = {r[0]: (r.n, r.lo, r.hi, r.d) for r in ci.file_rows(df).collect()}
    for f, own in numbers.items():
        known = [n for n in own if n is not None]
        assert got[f] == (len(own), min(known, default=None), max(known, default=None), len(set(known))), f
    assert "distinct" not in plan(ci.file_rows(df))


def test_written_tables_are_compressed_with_zstd(spark, tmp_root):
    path = Catalog(spark, f"{tmp_root}/wh").write_version(spark.range(5), "silver", "t", "v")
    files = [f[0] for f in spark.read.parquet(path).select("_metadata.file_name").distinct().collect()]
    assert files and all(".zstd." in f for f in files)


def test_unique_dealt_by_key_equals_unique(spark):
    rows = [(f"{i % 37}", i % 5, i) for i in range(300)] + [(None, 1, 1), (None, 1, 1), ("x", None, 1)]
    df = spark.createDataFrame(rows, "a string, b int, i int")
    for columns in ("a", ["a", "b"], ["a", "i"], ["b", "i"]):
        assert sorted(q.unique(df, columns, 7).collect()) == sorted(q.unique(df, columns).collect()), columns
    assert "REPARTITION_BY_NUM" in plan(q.unique(df, ["a", "b"], 7))


@pytest.mark.parametrize("name", ["dq_unique_composite", "dq_unique_key_string"])
def test_tasks_that_count_keys_grow_with_the_rows(spark, monkeypatch, name):
    """6,000 order lines, 1,500 reviews: a task counts at most so many keys, and AQE does not merge the tasks."""
    monkeypatch.setattr(catalogue, "KEYS_PER_TASK", 100)
    p = plan(catalogue.all_queries()[name](spark, SF_SMALL))
    lines = -(-spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 100)
    assert p.count(f", {lines}), REPARTITION_BY_NUM") == 3      # order lines twice, payments
    assert p.count("REPARTITION_BY_NUM") == 4


@pytest.mark.parametrize("name, text", [("stg_orders", "order_purchase_timestamp"), ("stg_order_items", "price"),
                                        ("stg_order_payments", "payment_value"),
                                        ("stg_order_reviews", "review_creation_date")])
def test_silver_parses_before_it_shuffles(spark, name, text):
    """Below the exchange of the dedup the parsed value is there already, above it its text is not."""
    raw = spark.createDataFrame([], contract(catalogue.SILVER[name][1]).bronze_schema())
    p = plan(catalogue.SILVER[name][0](raw))
    above, below = p.split("Exchange hashpartitioning", 1)
    assert f"({text}#" not in above and f"({text}#" in below


def test_suspects_of_unique_tests_are_short_hashes(spark, monkeypatch, tmp_root):
    """Keys of one hash that differ are told apart, however short the hash is."""
    from strata.plans import suite
    df = spark.createDataFrame([(i, i % 90) for i in range(100)], "a int, b int")
    checks = [suite.Check("gold", "t", "unique", (c,)) for c in ("a", "b")]
    for bits in (suite.HASH_BITS, 3, 1):
        monkeypatch.setattr(suite, "HASH_BITS", bits)
        got = {r.test_name: r.failures for r in suite.summary({"t": df}, checks).collect()}
        assert got == {"unique:t.a": 0, "unique:t.b": 10}, bits
