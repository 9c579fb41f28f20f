"""Registry of the engine's queries over the driver's test tables.

Each query is ``(spark, sf_dir) -> DataFrame``: it derives the Bronze tables
from the parquet inputs (``sources.adapters``) and runs one model or check on
the whole of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.plans.layers import GOLD, ORDER_MODELS, SILVER, Layers
from strata.sources.adapters import Bronze, land_files, land_lines, land_rows, landing_from_frames

Query = Callable[[SparkSession, str], DataFrame]


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(Bronze(spark, sf_dir))


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return layers(spark, sf_dir)[name]
    run.__name__ = name
    return run


def model_queries() -> dict[str, Query]:
    return {name: _model_query(name) for name in list(SILVER) + list(GOLD)}


def model_oracles() -> dict[str, str]:
    from strata import oracle
    return {name: oracle.model(name) for name in list(SILVER) + list(GOLD)}


# ---------------------------------------------------------------- analytics, quality
def analytic_queries() -> dict[str, Query]:
    from strata.plans import analytics as a

    def aq_daily_sales(spark, sf_dir):
        return a.daily_sales_overview(layers(spark, sf_dir)["mart_daily_sales"])

    def aq_category_quality(spark, sf_dir):
        t = layers(spark, sf_dir)
        return a.category_quality(t["fact_order_items"], t["dim_product"],
                                  t["dim_product_category"], t["fact_orders"])

    def aq_seller_geography(spark, sf_dir):
        t = layers(spark, sf_dir)
        return a.seller_geography(t["fact_order_items"], t["dim_seller"], t["dim_geography"])

    return {"aq_daily_sales": aq_daily_sales, "aq_category_quality": aq_category_quality,
            "aq_seller_geography": aq_seller_geography}


def _composite(c) -> bool:
    return c.kind == "unique" and len(c.columns) == 2


# Keys that a task counts, about 200 bytes each.
KEYS_PER_TASK = 1_000_000


def _key_tasks(t: Layers, tables: set[str]) -> dict[str, int]:
    """Into how many tasks the keys of Silver and Gold tables are dealt: by the
    rows of Bronze behind each, which come from the files' footers."""
    behind = {x: SILVER[x if x in SILVER else GOLD[x][1][0]][1] for x in tables}
    rows = {raw: t[raw].count() for raw in set(behind.values())}
    return {x: max(int(t[raw].sparkSession.conf.get("spark.sql.shuffle.partitions")),
                   -(-rows[raw] // KEYS_PER_TASK)) for x, raw in behind.items()}


def quality_queries() -> dict[str, Query]:
    from functools import reduce

    from pyspark.sql import functions as F

    from strata.plans import suite as s

    def dq_suite(spark, sf_dir):
        """All 82 declared tests, run the way the pipeline runs them: over the
        written, published Silver and Gold tables (and the Bronze tables)."""
        from strata.plans.buckets import Buckets
        from strata.plans.build import build, published_tables
        catalog = _scratch_catalog(spark, "dq-suite")
        bronze = _published_bronze(spark, catalog, sf_dir)
        built = build(spark, catalog, bronze, on_failure="skip")
        tables = dict(published_tables(catalog))
        tables.update({c.name: bronze[c.name] for c in _contracts()})
        silver = catalog.current("silver")
        with Buckets(spark, built.buckets) as buckets:      # as published, known to lie in buckets
            tables.update({m: buckets.read(silver[m].paths[0], "order_id") for m in ORDER_MODELS})
            return s.summary(tables, in_buckets=dict.fromkeys(ORDER_MODELS, "order_id"))

    def dq_not_null(spark, sf_dir):
        return s.summary(layers(spark, sf_dir), s.select(kind="not_null"))

    def dq_relationships(spark, sf_dir):
        return s.summary(layers(spark, sf_dir), s.select(kind="relationships"))

    def dq_unique(spark, sf_dir):
        t = layers(spark, sf_dir)
        parts = [s.violations(c, t).select(
                     F.lit(c.layer).alias("layer"), F.lit(c.table).alias("table_name"),
                     F.lit(c.columns[0]).alias("column_name"),
                     F.col(c.columns[0]).cast("string").alias("key_value"), "n_records")
                 for c in s.select(kind="unique") if not _composite(c)]
        return reduce(lambda x, y: x.unionByName(y), parts)

    def dq_unique_composite(spark, sf_dir):
        t, checks = layers(spark, sf_dir), [c for c in s.select(kind="unique") if _composite(c)]
        tasks = _key_tasks(t, {c.table for c in checks})
        parts = [s.violations(c, t, tasks[c.table]).select(
                     F.lit(c.layer).alias("layer"), F.lit(c.table).alias("table_name"),
                     F.col(c.columns[0]).cast("string").alias("key_1"),
                     F.col(c.columns[1]).cast("string").alias("key_2"), "n_records")
                 for c in checks]
        return reduce(lambda x, y: x.unionByName(y), parts)

    def dq_unique_key_string(spark, sf_dir):
        """The composite unique tests as they are declared: on the string of the
        key's parts (null if a part is)."""
        from strata.functions.clean import key_concat
        from strata.operators import quality as q
        t, checks = layers(spark, sf_dir), [c for c in s.select(kind="unique") if _composite(c)]
        tasks = _key_tasks(t, {c.table for c in checks})
        parts = [q.unique(t[c.table].select(key_concat(*c.columns).alias("key_string")), "key_string",
                          tasks[c.table])
                 .select(F.lit(c.table).alias("table_name"), "key_string", "n_records")
                 for c in checks]
        return reduce(lambda x, y: x.unionByName(y), parts)

    def dq_accepted_values(spark, sf_dir):
        c = s.select(kind="accepted_values")[0]
        return s.violations(c, layers(spark, sf_dir)).select(
            F.lit(c.table).alias("table_name"), F.lit(c.columns[0]).alias("column_name"),
            F.col("value").cast("string").alias("value"), "n_records")

    def dq_delivery_before_purchase(spark, sf_dir):
        return s.delivery_before_purchase(layers(spark, sf_dir)["fact_orders"])

    def dq_negative_amounts(spark, sf_dir):
        return s.negative_amounts(layers(spark, sf_dir)["fact_orders"])

    def dq_freshness(spark, sf_dir):
        """Load freshness of every source at three clocks after the load."""
        t = layers(spark, sf_dir)
        parts = [s.freshness_report(t, now=clock).withColumn("checked_at", F.lit(str(clock)))
                 for clock in _clocks()]
        return reduce(lambda x, y: x.unionByName(y), parts)

    def dq_parse_failures(spark, sf_dir):
        """Per parsed raw column: values present in Bronze that Silver turns
        into NULL because they do not parse."""
        from strata.operators.quality import parse_failures
        from strata.plans.silver import PARSED
        t = layers(spark, sf_dir)
        parts = []
        for table, parsers in PARSED.items():
            counts = parse_failures(t[table], parsers)
            stacked = F.explode(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"))
                for c in parsers])).alias("p")
            parts.append(counts.select(stacked).select(
                F.lit(table).alias("table_name"), "p.column_name", "p.failures"))
        return reduce(lambda x, y: x.unionByName(y), parts)

    return {f.__name__: f for f in (
        dq_parse_failures, dq_suite, dq_not_null, dq_relationships, dq_unique, dq_unique_composite,
        dq_unique_key_string, dq_accepted_values, dq_delivery_before_purchase, dq_negative_amounts, dq_freshness)}


def analytic_oracles() -> dict[str, str]:
    from strata import oracle as o
    return {"aq_daily_sales": o.AQ_DAILY, "aq_category_quality": o.AQ_CATEGORY,
            "aq_seller_geography": o.AQ_SELLER}


def quality_oracles() -> dict[str, str]:
    from strata import oracle as o
    from strata.plans import suite as s
    singles = [c for c in s.select(kind="unique") if not _composite(c)]
    pairs = [c for c in s.select(kind="unique") if _composite(c)]
    return {
        "dq_suite": o.suite_sql(s.CHECKS),
        "dq_not_null": o.suite_sql(s.select(kind="not_null")),
        "dq_relationships": o.suite_sql(s.select(kind="relationships")),
        "dq_unique": o.unique_values_sql(singles),
        "dq_unique_composite": o.unique_pairs_sql(pairs),
        "dq_unique_key_string": o.unique_strings_sql(pairs),
        "dq_accepted_values": o.accepted_values_sql(s.select(kind="accepted_values")[0]),
        "dq_delivery_before_purchase": o.DQ_DELIVERY,
        "dq_negative_amounts": o.DQ_NEGATIVE,
        "dq_freshness": o.freshness_sql(s.FRESHNESS_SOURCES, _clocks()),
        "dq_parse_failures": o.PARSE_FAILURES,
    }


def _scratch_catalog(spark: SparkSession, name: str):
    from strata.session import scratch_path
    from strata.sources.catalog import Catalog
    return Catalog(spark, scratch_path(spark, name))


def _clocks() -> list:
    """Fixed clocks: the load is fresh, late, and too late."""
    import datetime as dt

    from strata.sources.adapters import LOAD_TIME
    return [LOAD_TIME + dt.timedelta(hours=h) for h in (1, 13, 25)]


def _contracts():
    from strata.sources.contracts import CONTRACTS
    return CONTRACTS


def _published_bronze(spark: SparkSession, catalog, sf_dir: str):
    """Stage the raw tables as a published Bronze load (what an ingest leaves
    behind) and return the reader of that layer."""
    from strata.plans.build import publish_frames
    bronze = Bronze(spark, sf_dir)
    publish_frames(spark, catalog, "bronze", {c.name: bronze[c.name] for c in _contracts()})
    return catalog.reader("bronze")


def build_queries() -> dict[str, Query]:
    def warehouse_build(spark, sf_dir):
        """Full refresh (write, test, publish Silver then Gold) into a fresh
        warehouse; returns the published daily sales mart."""
        from strata.plans.build import build
        catalog = _scratch_catalog(spark, "build")
        build(spark, catalog, _published_bronze(spark, catalog, sf_dir), on_failure="warn")
        return catalog.read("gold", "mart_daily_sales")

    def gate_stops_build(spark, sf_dir):
        """A build that must stop: the raw customers arrive twice, so the Bronze
        gate fails and nothing is published.  Returns the tests that failed and
        the number of tables published after them."""
        from pyspark.sql import functions as F

        from strata.plans.build import GateFailed, build
        catalog = _scratch_catalog(spark, "gate")
        try:
            build(spark, catalog, _published_bronze(spark, catalog, sf_dir), on_failure="raise",
                  run_id="gated", check_freshness=False)
        except GateFailed:
            pass
        published = len(catalog.current("silver")) + len(catalog.current("gold"))
        return (catalog.test_results().where(F.col("status") == "fail")
                .select("layer", "table_name", "test_name", "severity", "failures",
                        F.lit(published).cast("bigint").alias("published_tables")))

    def gate_severities(spark, sf_dir):
        """Two builds over the same dirty data: in the first, uniqueness, accepted
        values and business rules only warn, and it publishes all layers; in the
        second the order lines may repeat no key, which stops it at Silver.  The
        tests that did not pass, with the failures of the run before, and the
        layers that the run has published."""
        from pyspark.sql import functions as F

        from strata.plans import suite as s
        from strata.plans.build import GateFailed, build
        catalog = _scratch_catalog(spark, "severities")
        bronze = _published_bronze(spark, catalog, sf_dir)
        lax = {c.test_name: {"severity": "warn"} for c in s.CHECKS if c.kind != "not_null"}
        strict = {k: v for k, v in lax.items() if k != "unique:stg_order_items.order_id+order_item_id"}
        for run, limits in (("1-lax", lax), ("2-strict", strict)):
            try:
                build(spark, catalog, bronze, on_failure="raise", run_id=run, check_freshness=False, limits=limits)
            except GateFailed:
                pass
        published = (catalog.manifest().where("layer <> 'bronze'")
                     .groupBy(F.col("publication_id").alias("run_id"))
                     .agg(F.countDistinct("layer").alias("published_layers")))
        return (s.trend(catalog.test_results()).where("failures > 0").join(published, "run_id", "left")
                .select("run_id", "layer", "test_name", "severity", "status", "failures", "failures_before",
                        "runs_not_passed", F.coalesce("published_layers", F.lit(0)).alias("published_layers")))

    def table_descriptions(spark, sf_dir):
        """The descriptions that a published Silver layer carries, read back
        with the rows of each table."""
        from functools import reduce

        from pyspark.sql import functions as F

        from strata.plans.layers import DESCRIPTIONS
        catalog, t = _scratch_catalog(spark, "described"), layers(spark, sf_dir)
        names = ("stg_customers", "stg_products", "stg_sellers")
        for name in names:
            catalog.write_version(t[name], "silver", name, "v1")
        catalog.publish("silver", {n: ("v1", None) for n in names}, descriptions=DESCRIPTIONS)
        rows = reduce(lambda x, y: x.unionByName(y), [
            catalog.read("silver", n).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("table_name", F.lit(n)) for n in names])
        return catalog.manifest().select("table_name", "description").join(rows, "table_name")

    return {f.__name__: f for f in (warehouse_build, gate_stops_build, gate_severities,
                                    table_descriptions)}


def build_oracles() -> dict[str, str]:
    from strata import oracle as o
    from strata.plans import suite as s
    from strata.plans.layers import DESCRIPTIONS
    return {"warehouse_build": o.model("mart_daily_sales"),
            "gate_stops_build": o.gate_sql(s.select("bronze")),
            "gate_severities": o.severities_sql(s.select("bronze"), s.select("silver"), s.select("gold")),
            "table_descriptions": o.descriptions_sql(
                {n: DESCRIPTIONS[n] for n in ("stg_customers", "stg_products", "stg_sellers")})}


# ---------------------------------------------------------------- extensions
def extension_queries() -> dict[str, Query]:
    from pyspark.sql import functions as F

    from functools import reduce

    from strata.operators import incremental as inc
    from strata.plans.silver import stg_orders
    from strata.session import scratch_path
    from strata.sources import adapters
    from strata.sources import csv_ingest as ci
    from strata.sources.contracts import contract

    def landed_by_month(spark, sf_dir, name):
        """Orders landed as a file per month; the contract and the folder."""
        root, c = scratch_path(spark, name), contract("raw_orders")
        rows = adapters.raw_orders(spark, sf_dir)
        land_rows(rows, f"{root}/{c.file}", c, month_of("order_purchase_timestamp"))
        return c, root

    def month_of(column):
        return F.date_format(F.col(column).cast("timestamp_ntz"), "yyyyMM")

    def ex_batch_id(spark, sf_dir):
        """Content ids of landed files: a digest tree over their lines."""
        from strata.sources.records import content_ids
        c, root = landed_by_month(spark, sf_dir, "batches")
        return content_ids(spark, f"{root}/{c.file}").select(
            F.regexp_extract("uri", "part=([0-9]+)", 1).alias("month"), "lines", "batch_id")

    def ex_record_id(spark, sf_dir):
        """Deterministic ids of all records: SHA-256(batch id || '-' || row
        number in the file) of files that were ingested."""
        from strata.sources.catalog import Catalog
        c, root = landed_by_month(spark, sf_dir, "ids")
        catalog = Catalog(spark, f"{root}/warehouse")
        ci.ingest_increment(spark, catalog, root, [c], load_id="ids")
        batches = catalog.batch_ledger().select(
            F.regexp_extract("source_file", "part=([0-9]+)", 1).alias("month"), "batch_id")
        rows = catalog.read("bronze", c.name).withColumn("month", month_of("order_purchase_timestamp"))
        return rows.join(batches, "month").select(
            "order_id", inc.record_id("batch_id", ci.SOURCE_ROW).alias("record_id"))

    def ex_ledger(spark, sf_dir):
        """Three runs over one landing folder: the second finds every file known
        by its stamp and reads none; before the third all files are delivered
        again under other names, and some corrected orders.  After each run: its
        status, the files the ledger knows and the rows loaded so far."""
        from strata.sources.catalog import Catalog
        c, root = landed_by_month(spark, sf_dir, "ledger")
        catalog, rows = Catalog(spark, f"{root}/warehouse"), []
        for run in (1, 2, 3):
            if run == 3:
                land_rows(adapters.raw_orders(spark, sf_dir), f"{root}/{c.file}/again", c,
                              month_of("order_purchase_timestamp"))
                land_rows(adapters.raw_orders_corrections(spark, sf_dir), f"{root}/{c.file}/corrected", c,
                              F.lit("corrected"))
            done = ci.ingest_increment(spark, catalog, root, [c], load_id=f"run-{run}")
            # Counted now: the ledger's folder is the same in each run, and Spark would reuse one scan.
            known = catalog.batch_ledger().select("source_file").distinct().count()
            rows.append(catalog.read("bronze", c.name).agg(F.count(F.lit(1)).alias("loaded_rows")).select(
                F.lit(run).alias("run"), F.lit(done.status).alias("status"),
                F.lit(known).cast("bigint").alias("known_files"), "loaded_rows"))
        return rows[0].unionByName(rows[1]).unionByName(rows[2])

    def ex_quarantine_bytes(spark, sf_dir):
        """Sellers landed with, for each of them, a record with a byte that is
        not UTF-8 and one that lacks a column, ingested under a quarantine: the
        rows that were published, and those kept out, with their bytes."""
        from strata.sources.catalog import Catalog
        root, c = scratch_path(spark, "bytes"), contract("raw_sellers")
        seller = [F.coalesce(F.col(x), F.lit("")).cast("binary") for x in c.columns]
        comma = F.lit(",").cast("binary")
        whole = F.concat(seller[0], comma, seller[1], comma, seller[2], comma, seller[3])
        spoilt = F.concat(seller[0], comma, seller[1], comma, seller[2], F.lit(b"\xff"), comma, seller[3])
        short = F.concat(seller[0], comma, seller[1], comma, seller[2])
        lines = adapters.raw_sellers(spark, sf_dir).select(
            F.pmod(F.col(ci.SOURCE_ROW), F.lit(3)).alias("part"), F.col(ci.SOURCE_ROW).alias("row"),
            F.explode(F.array(*[x.cast("string") for x in (whole, spoilt, short)])).alias("value"))
        land_files(lines, f"{root}/{c.file}", c)
        catalog = Catalog(spark, f"{root}/warehouse")
        ci.ingest(spark, catalog, root, [c], quarantine=ci.Quarantine(max_share=0.7))
        good = catalog.read("bronze", c.name).select(
            F.lit("published").alias("kind"), "seller_id", F.lit(None).cast("string").alias("bytes"))
        return good.unionByName(catalog.quarantine(c.name).select(
            F.col("reason").alias("kind"), F.lit(None).cast("string").alias("seller_id"),
            F.hex("raw").alias("bytes")))

    def backfilled(spark, sf_dir):
        """A published warehouse after a load that corrects the orders of a month
        and the backfill of what they touch."""
        from strata.plans.backfill import backfill
        from strata.plans.build import build
        catalog = _scratch_catalog(spark, "backfill")
        build(spark, catalog, _published_bronze(spark, catalog, sf_dir), on_failure="skip")
        changes = adapters.raw_orders_corrections(spark, sf_dir)
        catalog.write_version(changes, "bronze", "raw_orders", "corrections")
        catalog.publish("bronze", {"raw_orders": ("corrections", None)}, append=("raw_orders",))
        backfill(spark, catalog, {"raw_orders": spark.read.parquet(
            catalog.version_path("bronze", "raw_orders", "corrections"))})
        return catalog

    def ex_backfill(spark, sf_dir):
        """The order fact after a bounded backfill; equals a full rebuild."""
        return backfilled(spark, sf_dir).read("gold", "fact_orders").drop("order_month")

    def ex_backfill_mart(spark, sf_dir):
        """The daily sales mart after a bounded backfill; equals a full rebuild."""
        return backfilled(spark, sf_dir).read("gold", "mart_daily_sales")

    def ex_schema_types(spark, sf_dir):
        """Order lines with a narrower, a wider and an unlike type of a column,
        taken into the table under each policy, or refused."""
        current = layers(spark, sf_dir)["stg_order_items"]
        changes = {"narrower": ("order_item_id", "int"), "wider": ("price", "decimal(22,4)"),
                   "unlike": ("shipping_limit_at", "string")}
        parts = []
        for policy in ("fail", "append_new_columns", "sync_all_columns"):
            for change, (column, kind) in changes.items():
                incoming = current.withColumn(column, F.col(column).cast(kind))
                try:
                    taken, outcome = inc.apply_schema_policy(incoming, current, policy), "taken"
                except inc.SchemaChange:
                    taken, outcome = current.limit(0), "refused"
                parts.append(taken.agg(
                    F.count(F.lit(1)).alias("rows"), F.sum("price").cast("decimal(38,2)").alias("value")).select(
                        F.lit(policy).alias("policy"), F.lit(change).alias("change"),
                        F.lit(outcome).alias("outcome"),
                        F.lit(taken.schema[column].dataType.simpleString()).alias("column_type"), "rows", "value"))
        return reduce(DataFrame.unionByName, parts)

    def ex_reconcile_keys(spark, sf_dir):
        """What each order's lines add up to, against a copy of the order fact
        that has lost some orders and has other values in some: the keys by name,
        found by descending into the buckets that differ."""
        t = layers(spark, sf_dir)
        n = F.col("order_id").cast("bigint")
        silver = (t["stg_order_items"].groupBy("order_id").agg(
            F.count(F.lit(1)).alias("items"), F.sum("price").cast("decimal(38,2)").alias("value")))
        gold = t["fact_orders"].where("item_count > 0").where(n % 503 != 0).select(
            "order_id", F.col("item_count").alias("items"),
            (F.col("item_value") + F.when(n % 499 == 1, 1).otherwise(0)).cast("decimal(38,2)").alias("value"))
        silver = silver.join(t["stg_orders"].select("order_id"), "order_id", "left_semi")
        return inc.differences(silver, gold, ["order_id"], ["items", "value"])

    def ex_upsert(spark, sf_dir):
        """Orders after a second load: newest row per order wins."""
        current = layers(spark, sf_dir)["stg_orders"]
        incoming = stg_orders(adapters.raw_orders_changes(spark, sf_dir))
        return inc.upsert(current, incoming, ["order_id"], ["_loaded_at"])

    def ex_upsert_buckets(spark, sf_dir):
        """Orders in a table keyed by buckets, after a load that corrects a
        month's orders: only the buckets these fall into are read and written."""
        from strata.plans.keyed import BUCKET, upsert_into
        catalog = _scratch_catalog(spark, "keyed")
        for load in (adapters.raw_orders(spark, sf_dir), adapters.raw_orders_corrections(spark, sf_dir)):
            upsert_into(catalog, "silver", "orders", stg_orders(load), ["order_id"], ["_loaded_at"], buckets=128)
        return catalog.read("silver", "orders").drop(BUCKET)

    def ex_lookback(spark, sf_dir):
        """Incremental slice of events: already loaded up to 2024-01-15, take
        source rows from the loaded maximum minus 24 hours."""
        events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        target = events.where(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
        return inc.lookback_filter(events, target, "ts", 24)

    def ex_reconcile(spark, sf_dir):
        """Orders whose raw items and order fact differ in count or value."""
        t = layers(spark, sf_dir)
        from strata.functions.clean import blank_to_null, parse_decimal
        raw = (t["raw_order_items"].groupBy(blank_to_null("order_id").alias("order_id"))
               .agg(F.count(F.lit(1)).alias("items"),
                    F.sum(parse_decimal("price")).cast("decimal(38,2)").alias("value")))
        fact = t["fact_orders"].select("order_id", F.col("item_count").alias("items"),
                                       F.col("item_value").cast("decimal(38,2)").alias("value"))
        return inc.reconcile(raw, fact, ["order_id"], ["items", "value"]).select(
            "order_id", F.col("left_items").alias("raw_items"),
            F.col("right_items").alias("fact_items"), F.col("left_value").alias("raw_value"),
            F.col("right_value").alias("fact_value"))

    def ex_reconcile_kpis(spark, sf_dir):
        """Order count, sales and number of days, of the order fact and of the
        mart: the totals of both layers (``ex_reconcile_keys`` names keys)."""
        t = layers(spark, sf_dir)
        fact, mart = t["fact_orders"], t["mart_daily_sales"]

        def totals(df, layer, orders, day):
            return df.where(F.col(day).isNotNull()).agg(
                F.sum(orders).cast("bigint").alias("orders"),
                F.sum("item_value").cast("decimal(38,2)").alias("item_value"),
                F.sum("payment_value").cast("decimal(38,2)").alias("payment_value"),
                F.countDistinct(day).alias("days")).withColumn("layer", F.lit(layer))
        return totals(fact.withColumn("one", F.lit(1)), "fact", "one", "order_date_key").unionByName(
            totals(mart, "mart", "order_count", "date_key"))

    def ex_schema_policy(spark, sf_dir):
        """Orders of a later load that brings a new column and lacks another,
        taken into the table under each of the accepting policies."""
        current = layers(spark, sf_dir)["stg_orders"]
        incoming = (stg_orders(adapters.raw_orders_changes(spark, sf_dir))
                    .drop("approved_at").withColumn("channel", F.lit("web")))
        parts = []
        for policy in ("append_new_columns", "sync_all_columns"):
            taken = inc.apply_schema_policy(incoming, current, policy)
            parts.append(taken.agg(
                F.count(F.lit(1)).alias("rows"), F.count("channel").alias("channels"),
                F.count("purchased_at").alias("purchases")).select(
                    F.lit(policy).alias("policy"),
                    F.lit(",".join(sorted(taken.columns))).alias("columns"),
                    "rows", "channels", "purchases"))
        return parts[0].unionByName(parts[1])

    def ex_stream_dedup(spark, sf_dir):
        """Events delivered twice, in files that mix all event times, streamed
        and upserted file by file into a table partitioned by event day (each
        batch rewrites only the days it touches)."""
        from strata.sources.catalog import Catalog
        from strata.streaming.ingest import UpsertSink, event_stream, run_available
        root = scratch_path(spark, "stream")
        events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        for n, copy in enumerate(("first", "redelivered"), 4):
            (events.repartition(n, F.xxhash64("event_id", F.lit(copy)))
             .write.parquet(f"{root}/source/{copy}"))
        src = f"{root}/source/*"
        stream = (event_stream(spark, src, events.schema, "ts", files_per_trigger=3)
                  .withColumn("event_day", F.to_date("ts")))
        catalog = Catalog(spark, f"{root}/warehouse")
        sink = UpsertSink(catalog, "silver", "events", ["event_id"], partition_by="event_day")
        run_available(stream, sink, f"{root}/checkpoint")
        return catalog.read("silver", "events").select(*events.columns)

    def ex_stream_late(spark, sf_dir):
        """The same events in nine files, through a sink with a watermark of an
        hour: late rows wait in a side table and are merged at the end."""
        from strata.sources.catalog import Catalog
        from strata.streaming.ingest import WatermarkSink, event_stream, run_available
        root = scratch_path(spark, "late")
        events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        for n, copy in enumerate(("first", "redelivered"), 4):
            (events.repartition(n, F.xxhash64("event_id", F.lit(copy)))
             .write.parquet(f"{root}/source/{copy}"))
        stream = (event_stream(spark, f"{root}/source/*", events.schema, "ts", files_per_trigger=3)
                  .withColumn("event_day", F.to_date("ts")))
        catalog = Catalog(spark, f"{root}/warehouse")
        sink = WatermarkSink(catalog, "silver", "events", ["event_id"], partition_by="event_day",
                             delay_seconds=3600)
        run_available(stream, sink, f"{root}/checkpoint")
        sink.merge_late()
        return catalog.read("silver", "events").select(*events.columns)

    def ex_quarantine(spark, sf_dir):
        """Sellers landed in files that hold, after each whole row, one that
        lacks its last column: the malformed rows are quarantined with their
        text, not loaded, and the whole ones are."""
        root = scratch_path(spark, "quarantine")
        c = contract("raw_sellers")
        lines = adapters.raw_sellers(spark, sf_dir).select(F.explode(F.array(
            F.concat_ws(",", *c.columns), F.concat_ws(",", *c.columns[:-1]))).alias("line"))
        land_lines(lines, f"{root}/{c.file}", c)
        good, bad = inc.read_with_quarantine(spark, f"{root}/{c.file}", c, f"{root}/parsed")
        return good.select(F.lit("good").alias("kind"), F.col("seller_id").alias("seller_id"),
                           F.col("seller_state").alias("state"), F.lit(None).cast("string").alias("text")
                           ).unionByName(bad.select(
                               F.lit("quarantined").alias("kind"), F.lit(None).cast("string").alias("seller_id"),
                               F.lit(None).cast("string").alias("state"), F.col(inc.CORRUPT).alias("text")))

    def ex_business_freshness(spark, sf_dir):
        """Freshness of the business event time (newest purchase), apart from
        the load time, at three clocks after the load."""
        from strata.operators.quality import freshness
        orders = layers(spark, sf_dir)["stg_orders"]
        return reduce(lambda x, y: x.unionByName(y), [
            freshness(orders, "purchased_at", now=clock).select(
                F.lit("stg_orders").alias("table_name"), F.lit(str(clock)).alias("checked_at"),
                F.col("max_loaded_at").alias("max_purchased_at"), "status") for clock in _clocks()])

    def ex_replay(spark, sf_dir):
        """Load the same orders extract twice: the Silver result of the rerun
        has the same rows, keys and order-free content hash as the first."""
        from strata.sources.catalog import Catalog
        root = scratch_path(spark, "replay")
        c = contract("raw_orders")
        landing_from_frames({c.name: adapters.raw_orders(spark, sf_dir)}, f"{root}/landing", [c])
        catalog = Catalog(spark, f"{root}/warehouse")
        prints = []
        for run in (1, 2):
            ci.ingest(spark, catalog, f"{root}/landing", contracts=[c], load_id=f"replay-{run}")
            silver = stg_orders(catalog.read("bronze", c.name)).drop("_loaded_at")
            prints.append(inc.fingerprint(silver, ["order_id"]).select(
                F.lit(run).alias("run"), "rows", "distinct_keys", "row_hash_sum"))
        first = prints[0].select(F.col("row_hash_sum").alias("_first"))
        return (prints[0].unionByName(prints[1]).crossJoin(first)
                .select("run", "rows", "distinct_keys",
                        (F.col("row_hash_sum") == F.col("_first")).alias("matches_first")))

    def ex_incremental_load(spark, sf_dir):
        """Two deliveries of the orders extract: the second redelivers every
        file of the first (skipped by content hash) and adds the changed
        orders; only the new files are loaded, appended as a segment, and the
        Silver dedup resolves each order to its newest load."""
        from strata.sources.catalog import Catalog
        root = scratch_path(spark, "incremental")
        c = contract("raw_orders")
        catalog = Catalog(spark, f"{root}/warehouse")
        landing_from_frames({c.name: adapters.raw_orders(spark, sf_dir)}, root, [c])
        ci.ingest_increment(spark, catalog, root, [c], load_id="delivery-1")
        landing_from_frames({c.name: adapters.raw_orders_changes(spark, sf_dir)}, root, [c],
                               mode="append")
        ci.ingest_increment(spark, catalog, root, [c], load_id="delivery-2")
        return stg_orders(catalog.read("bronze", c.name)).drop("_loaded_at")

    return {f.__name__: f for f in (ex_record_id, ex_upsert, ex_lookback, ex_reconcile,
                                    ex_stream_dedup, ex_quarantine, ex_business_freshness,
                                    ex_replay, ex_incremental_load, ex_reconcile_kpis,
                                    ex_schema_policy, ex_batch_id, ex_ledger, ex_quarantine_bytes,
                                    ex_backfill, ex_backfill_mart, ex_schema_types, ex_reconcile_keys,
                                    ex_upsert_buckets, ex_stream_late)}


def extension_oracles() -> dict[str, str]:
    from strata import oracle as o
    return {"ex_record_id": o.EX_RECORD_ID, "ex_upsert": o.EX_UPSERT,
            "ex_lookback": o.EX_LOOKBACK, "ex_reconcile": o.EX_RECONCILE,
            "ex_stream_dedup": o.EX_STREAM, "ex_stream_late": o.EX_STREAM, "ex_quarantine": o.EX_QUARANTINE,
            "ex_business_freshness": o.business_freshness_sql(_clocks()), "ex_replay": o.EX_REPLAY,
            "ex_incremental_load": o.EX_INCREMENTAL, "ex_reconcile_kpis": o.EX_RECONCILE_KPIS,
            "ex_schema_policy": o.EX_SCHEMA_POLICY, "ex_batch_id": o.EX_BATCH_ID,
            "ex_ledger": o.EX_LEDGER, "ex_quarantine_bytes": o.EX_QUARANTINE_BYTES,
            "ex_backfill": o.rebuilt("fact_orders"), "ex_backfill_mart": o.rebuilt("mart_daily_sales"),
            "ex_upsert_buckets": o.rebuilt("stg_orders"), "ex_schema_types": o.EX_SCHEMA_TYPES, "ex_reconcile_keys": o.EX_RECONCILE_KEYS}


# ---------------------------------------------------------------- Bronze ingest
HISTORY = ("raw_customers", "raw_products", "raw_sellers")


def _ingest_roundtrip(spark: SparkSession, sf_dir: str):
    from strata.session import scratch_path
    from strata.sources import csv_ingest as ci
    from strata.sources.catalog import Catalog
    from strata.sources.contracts import CONTRACTS

    root = scratch_path(spark, "ingest")
    landing = f"{root}/landing"
    bronze = Bronze(spark, sf_dir)
    landing_from_frames({c.name: bronze[c.name] for c in CONTRACTS}, landing)
    catalog = Catalog(spark, f"{root}/warehouse")
    ci.ingest(spark, catalog, landing)
    return catalog


def ingest_queries() -> dict[str, Query]:
    from functools import reduce

    from pyspark.sql import functions as F

    from strata.plans import analytics as a
    from strata.sources.contracts import CONTRACTS
    from strata.sources.csv_ingest import file_rows

    def ingest_csv_roundtrip(spark, sf_dir):
        """Land the raw tables as CSV, ingest them strictly, and profile the
        published Bronze versions (rows, NULL cells, distinct first column,
        file row numbers that do not fit their file)."""
        catalog = _ingest_roundtrip(spark, sf_dir)
        published = catalog.reader("bronze")
        parts = []
        for c in CONTRACTS:
            df = published[c.name]
            nulls = reduce(lambda x, y: x + y,
                           [F.col(col).isNull().cast("bigint") for col in c.columns])
            bad = file_rows(df).agg(F.count_if((F.col("lo") != 1) | (F.col("hi") != F.col("n"))
                                          | (F.col("d") != F.col("n"))).alias("bad_files"))
            stats = df.agg(F.count(F.lit(1)).alias("row_count"),
                           F.sum(nulls).cast("bigint").alias("null_cells"),
                           F.countDistinct(c.columns[0]).alias("distinct_first_column"))
            parts.append(stats.crossJoin(bad).select(
                F.lit(c.name).alias("table_name"), "row_count", "null_cells",
                "distinct_first_column", "bad_files"))
        return reduce(lambda x, y: x.unionByName(y), parts)

    def _two_loads(spark, sf_dir):
        """Three datasets loaded once, in two files each, and once more with a
        file of rows that lack a column among the sellers."""
        from strata.session import scratch_path
        from strata.sources import csv_ingest as ci
        from strata.sources.catalog import Catalog
        root, bronze = scratch_path(spark, "history"), Bronze(spark, sf_dir)
        loaded = [c for c in CONTRACTS if c.name in HISTORY]
        landing_from_frames({c.name: bronze[c.name] for c in loaded}, f"{root}/landing", loaded,
                               files_per_dataset=2)
        catalog = Catalog(spark, f"{root}/warehouse")
        ci.ingest(spark, catalog, f"{root}/landing", loaded, load_id="load-1")
        sellers = next(c for c in loaded if c.name == "raw_sellers")
        land_lines(bronze["raw_sellers"].select(F.concat_ws(",", *sellers.columns[:-1])),
                    f"{root}/landing/{sellers.file}", sellers, mode="append")
        try:
            ci.ingest(spark, catalog, f"{root}/landing", loaded, load_id="load-2")
        except Exception as e:
            if "MALFORMED" not in str(e):
                raise
        return catalog

    def load_run_history(spark, sf_dir):
        """Run history after a published load and one that a ragged file
        stopped (AQ1).  The times of the runs are left out."""
        history = a.load_run_history(_two_loads(spark, sf_dir).run_audit())
        return history.select("load_id", "status", "expected_files", "loaded_files", "expected_rows",
                              "loaded_rows", F.col("error_message").isNotNull().alias("has_error"),
                              (F.col("completed_at") >= F.col("started_at")).alias("has_ended"))

    def file_audit(spark, sf_dir):
        """The audited files of the published load, counted per table (the
        names of the files differ from run to run)."""
        audit = _two_loads(spark, sf_dir).file_audit()
        return audit.groupBy("load_id", "target_table").agg(
            F.countDistinct("source_file").alias("files"),
            F.sum("loaded_rows").cast("bigint").alias("loaded_rows"))

    def ingest_gzip(spark, sf_dir):
        """Products landed as gzip files, ingested strictly and profiled."""
        from strata.session import scratch_path
        from strata.sources import csv_ingest as ci
        from strata.sources.catalog import Catalog
        root, bronze = scratch_path(spark, "gzip"), Bronze(spark, sf_dir)
        c = next(c for c in CONTRACTS if c.name == "raw_products")
        (bronze[c.name].select(*c.columns).write.option("header", True).option("escape", '"')
         .option("nullValue", "").option("compression", "gzip").csv(f"{root}/landing/{c.file}"))
        catalog = Catalog(spark, f"{root}/warehouse")
        ci.ingest(spark, catalog, f"{root}/landing", [c], load_id="gz")
        df = catalog.read("bronze", c.name)
        return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("product_id").alias("products"),
                      F.count("product_category_name").alias("with_category"),
                      F.countDistinct("_source_file", "_source_row_number").alias("places"))

    return {f.__name__: f for f in (ingest_csv_roundtrip, load_run_history, file_audit, ingest_gzip)}


def ingest_oracles() -> dict[str, str]:
    from strata import oracle as o
    from strata.sources.contracts import CONTRACTS
    parts = []
    for c in CONTRACTS:
        nulls = " + ".join(f"cast({col} is null as bigint)" for col in c.columns)
        parts.append(f"select '{c.name}' as table_name, count(*) as row_count, "
                     f"cast(sum({nulls}) as bigint) as null_cells, "
                     f"count(distinct {c.columns[0]}) as distinct_first_column, "
                     f"cast(0 as bigint) as bad_files from {c.name}")
    return {"ingest_csv_roundtrip": o.query("\nunion all\n".join(parts),
                                            *[c.name for c in CONTRACTS]),
            "load_run_history": o.RUN_HISTORY, "file_audit": o.FILE_AUDIT,
            "ingest_gzip": o.INGEST_GZIP}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (model_queries, analytic_queries, quality_queries, ingest_queries,
                 build_queries, extension_queries):
        out.update(part())
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (model_oracles, analytic_oracles, quality_oracles, ingest_oracles,
                 build_oracles, extension_oracles):
        out.update(part())
    return out

