"""A build moves the rows of an order once, in buckets, and publishes the rows that the lazy models have."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as q
from strata.operators.dedup import latest_by
from strata.plans import buckets as b
from strata.plans import gold, suite
from strata.plans.build import build
from strata.plans.layers import GOLD, ORDER_MODELS, SILVER, Layers
from strata.plans.silver import ORDER, typed, with_order
from strata.sources import fs
from strata.sources.adapters import Bronze
from strata.sources.catalog import Catalog
from strata.sources.contracts import LOADED_AT, SOURCE_ROW, contract

from small_data import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> Counter:
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def dirty(spark):
    """Raw tables with null, blank and padded order ids, which also repeat."""
    raw = {name: Bronze(spark, SF_SMALL)[name] for _, name in SILVER.values()}
    ids = F.explode(F.array(*[F.lit(x) for x in (None, "  ", " 7", "7 ", "7", " 7")]))
    for model in ORDER_MODELS:
        name = SILVER[model][1]
        odd = raw[name].orderBy(SOURCE_ROW, *contract(name).columns).limit(3)
        raw[name] = raw[name].unionByName(odd.withColumn("order_id", ids).withColumn(
            SOURCE_ROW, F.monotonically_increasing_id() + (1 << 61)))
        raw[name] = raw[name].localCheckpoint()         # row numbers must not change
    return raw


def test_build_publishes_what_the_lazy_models_have(spark, tmp_root, monkeypatch, dirty):
    monkeypatch.setattr(b, "LEAST_ROWS", 200)
    monkeypatch.setattr(b, "ROWS_PER_BUCKET", 150)
    monkeypatch.setattr(b, "ROWS_PER_PIECE", 30)
    tables = {t.name for t in spark.catalog.listTables()}
    catalog, lazy = Catalog(spark, f"{tmp_root}/wh"), Layers(dirty)
    build(spark, catalog, dirty, on_failure="warn")
    for layer, names in (("silver", SILVER), ("gold", GOLD)):
        published = catalog.reader(layer)
        for name in names:
            assert rows(published[name].drop("order_month")) == rows(lazy[name]), name
    got = {r.test_name: r.failures for r in catalog.test_results().where("test_name not like 'fresh%'").collect()}
    want = {r.test_name: r.failures for r in suite.summary(
        {**dirty, **{n: lazy[n] for n in (*SILVER, *GOLD)}}).collect()}
    assert got == want
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_models_of_staged_order_tables_need_no_exchange(spark, dirty):
    with b.settings(spark), b.Buckets(spark, 4) as buckets:
        silver = {}
        for model in ORDER_MODELS:
            make, raw = SILVER[model]
            made = make(buckets.stage(with_order(typed(dirty[raw], raw)), raw, ORDER))
            assert "Exchange" not in plan(made), model
            silver[model] = buckets.write(made, f"{buckets.staging}/{model}", "order_id")
        facts = gold.fact_orders(*silver.values(), metrics_of_items=gold.item_metrics_in_place)
        for df in (facts, q.unique(silver["stg_order_items"], ["order_id", "order_item_id"])):
            assert "Exchange hash" not in plan(df)
        some = silver["stg_order_items"].where("order_id is not null")
        assert rows(gold.item_metrics_in_place(some)) == rows(gold.item_metrics(some))
        with pytest.raises(FileExistsError):
            buckets.write(made, f"{buckets.staging}/{ORDER_MODELS[0]}", "order_id")
    assert not fs.exists(spark, buckets.staging)


def test_facts_are_put_together_by_month_without_an_exchange(spark):
    days = spark.range(4000).select(F.col("id").cast("string").alias("order_id"),
                                    F.when(F.col("id") % 10 > 0, F.lit(202401)).when(F.col("id") % 20 > 0, 202402)
                                    .cast("int").alias("month"))
    sizes = {r[0]: r[1] for r in days.groupBy("month").count().collect()}
    assert sizes == {202401: 3600, 202402: 200, None: 200}
    with pytest.MonkeyPatch.context() as m, b.settings(spark), b.Buckets(spark, 6) as buckets:
        m.setattr(b, "ROWS_PER_PIECE", 1000)
        cut = days.repartition(5).withColumn("piece", b.piece(sizes, F.col("month"), F.col("order_id")))
        staged = buckets.stage(cut, "days", "piece", 5)
        assert "Exchange" not in plan(staged)
        b.whole_pieces(staged, "piece").write.partitionBy("month").parquet(f"{buckets.staging}/out")
        out = spark.read.parquet(f"{buckets.staging}/out")
        files = {r[0]: r[1] for r in out.groupBy("month").agg(F.countDistinct("_metadata.file_path")).collect()}
        assert files[202402] == files[None] == 1 and 1 < files[202401] <= 4
        assert rows(out.select("order_id", "month")) == rows(days)


def test_hot_keys_are_cut_before_they_are_put_into_buckets(spark, monkeypatch):
    monkeypatch.setattr(b, "ROWS_PER_BUCKET", 40)
    at = dt.datetime(2024, 1, 1)
    data = [("hot" if i % 2 else None if i % 3 else f"k{i}", i % 7, at, i) for i in range(600)]
    df = spark.createDataFrame(data, f"k string, v int, {LOADED_AT} timestamp, {SOURCE_ROW} long").repartition(3)
    cut = b.cut_hot(df, ["k"])
    assert cut.count() == 100 + 2
    assert rows(latest_by(cut, ["k"])) == rows(latest_by(df, ["k"]))
    assert b.cut_hot(df.where("k like 'k%'"), ["k"]).count() == 100
    assert b.cut_hot(df.limit(0), ["k"]).count() == 0


def test_unique_tests_in_place_equal_those_by_suspects(spark):
    data = [(i % 40, "a" if i % 3 else None, i) for i in range(90)] + [(None, "b", 1000), (None, "b", 1001)]
    df = spark.createDataFrame(data, "k int, s string, i int")
    checks = [suite.Check("silver", "t", "unique", c) for c in (("k",), ("k", "s"), ("i",), ("s", "i"))]
    with b.Buckets(spark, 3) as buckets:
        t = {"t": buckets.stage(df, "t", "k")}
        assert rows(suite.summary(t, checks, {"t": "k"})) == rows(suite.summary({"t": df}, checks))


def test_mart_with_customers_counted_apart(spark):
    fact = Layers(Bronze(spark, SF_SMALL))["fact_orders"].localCheckpoint()
    odd = fact.limit(5).withColumn("customer_key", F.lit(None).cast("string")).withColumn("order_date_key", F.lit(19010101))
    fact = fact.unionByName(odd).unionByName(odd.withColumn("order_date_key", F.lit(None).cast("int")))
    known = F.col("date_key").isNotNull()
    assert rows(gold.daily_sales_in_two(fact).where(known)) == rows(gold.daily_sales(fact).where(known))


def test_a_written_table_is_read_in_its_buckets(spark):
    """Also after its entry in the session catalogue is gone."""
    df = spark.createDataFrame([(f"{i % 50}", i, dt.datetime(2024, 1, 1)) for i in range(200)],
                               "k string, v int, t timestamp_ntz").withColumn("v", F.col("v").cast("decimal(18,2)"))
    path = f"{b.scratch_path(spark, 'read')}/t"
    with b.Buckets(spark, 4) as buckets:
        buckets.write(df, path, "k")
    with b.Buckets(spark, 4) as buckets:
        again = buckets.read(path, "k")
        counts = again.groupBy("k").count()
    assert "Exchange" not in plan(counts) and rows(again) == rows(df)
    assert {r["count"] for r in counts.collect()} == {4} and counts.count() == 50
