"""The data-quality suite: every declared test of every layer, as data.

A ``Check`` names a kind, a table and its columns; ``violations`` turns it into
the DataFrame of failing rows.  ``summary`` computes all failure counts of a
selection in one Spark job (all not-null tests of a table share one aggregate
pass); ``plans.build`` stops at a layer that fails them before the next layer
reads it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators import quality as q
from strata.session import scratch_path
from strata.sources.contracts import CONTRACTS, LOADED_AT


@dataclass(frozen=True)
class Check:
    layer: str                     # bronze | silver | gold
    table: str
    kind: str                      # not_null | unique | accepted_values | relationships | expression
    columns: tuple[str, ...]
    parent: tuple[str, str] | None = None          # relationships: (table, field)
    values: tuple = field(default=())              # accepted_values
    name: str = ""                                 # expression checks
    severity: str = "error"                        # error stops the build; warn is reported
    warn_above: int = 0                            # failures that are tolerated without a word
    error_above: int = 0                           # and those from which on an error stops the build

    def status(self, failures: int) -> str:
        if self.severity == "error" and failures > self.error_above:
            return "fail"
        return "warn" if failures > self.warn_above else "pass"

    @property
    def test_name(self) -> str:
        cols = "+".join(self.columns)
        if self.kind == "relationships":
            return f"relationships:{self.table}.{cols}->{self.parent[0]}.{self.parent[1]}"
        if self.kind == "expression":
            return f"expression:{self.table}.{self.name}"
        return f"{self.kind}:{self.table}.{cols}"


def _nn(layer, table, *cols):
    return [Check(layer, table, "not_null", (c,)) for c in cols]


def _u(layer, table, *cols):
    return [Check(layer, table, "unique", (c,)) for c in cols]


def _rel(layer, table, col, parent, fld):
    return [Check(layer, table, "relationships", (col,), parent=(parent, fld))]


# The declared tests of each layer.
BRONZE = [c for k in CONTRACTS for c in _nn("bronze", k.name, *k.not_null) + _u("bronze", k.name, *k.unique)]

SILVER = (
    _nn("silver", "stg_customers", "customer_id", "customer_unique_id")
    + _u("silver", "stg_customers", "customer_id")
    + _nn("silver", "stg_geolocation", "zip_code_prefix")
    + _u("silver", "stg_geolocation", "zip_code_prefix")
    + [Check("silver", "stg_order_items", "unique", ("order_id", "order_item_id"))]
    + _nn("silver", "stg_order_items", "order_id", "order_item_id", "price")
    + [Check("silver", "stg_order_payments", "unique", ("order_id", "payment_sequential"))]
    + _nn("silver", "stg_order_payments", "order_id")
    + [Check("silver", "stg_order_reviews", "unique", ("review_id", "order_id"))]
    + _nn("silver", "stg_order_reviews", "order_id")
    + [Check("silver", "stg_order_reviews", "accepted_values", ("review_score",),
             values=(1, 2, 3, 4, 5))]
    + _nn("silver", "stg_orders", "order_id") + _u("silver", "stg_orders", "order_id")
    + _nn("silver", "stg_orders", "customer_id")
    + _rel("silver", "stg_orders", "customer_id", "stg_customers", "customer_id")
    + _nn("silver", "stg_products", "product_id") + _u("silver", "stg_products", "product_id")
    + _nn("silver", "stg_sellers", "seller_id") + _u("silver", "stg_sellers", "seller_id")
    + _nn("silver", "stg_product_categories", "category_name")
    + _u("silver", "stg_product_categories", "category_name")
)

GOLD = (
    _nn("gold", "dim_geography", "geography_key") + _u("gold", "dim_geography", "geography_key")
    + _nn("gold", "dim_product_category", "product_category_key")
    + _u("gold", "dim_product_category", "product_category_key")
    + _nn("gold", "dim_product", "product_key") + _u("gold", "dim_product", "product_key")
    + _rel("gold", "dim_product", "product_category_key", "dim_product_category",
           "product_category_key")
    + _nn("gold", "dim_customer", "customer_key") + _u("gold", "dim_customer", "customer_key")
    + _rel("gold", "dim_customer", "geography_key", "dim_geography", "geography_key")
    + _nn("gold", "dim_seller", "seller_key") + _u("gold", "dim_seller", "seller_key")
    + _rel("gold", "dim_seller", "geography_key", "dim_geography", "geography_key")
    + _nn("gold", "dim_date", "date_key", "date_day") + _u("gold", "dim_date", "date_key", "date_day")
    + _nn("gold", "fact_orders", "order_id") + _u("gold", "fact_orders", "order_id")
    + _nn("gold", "fact_orders", "customer_key")
    + _rel("gold", "fact_orders", "customer_key", "dim_customer", "customer_key")
    + _nn("gold", "fact_orders", "order_date_key")
    + _rel("gold", "fact_orders", "order_date_key", "dim_date", "date_key")
    + [Check("gold", "fact_order_items", "unique", ("order_id", "order_item_id"))]
    + _nn("gold", "fact_order_items", "order_id")
    + _rel("gold", "fact_order_items", "order_id", "fact_orders", "order_id")
    + _nn("gold", "fact_order_items", "product_key")
    + _rel("gold", "fact_order_items", "product_key", "dim_product", "product_key")
    + _nn("gold", "fact_order_items", "seller_key")
    + _rel("gold", "fact_order_items", "seller_key", "dim_seller", "seller_key")
    + _nn("gold", "fact_order_items", "customer_key")
    + _rel("gold", "fact_order_items", "customer_key", "dim_customer", "customer_key")
    + _nn("gold", "fact_order_items", "order_date_key")
    + _rel("gold", "fact_order_items", "order_date_key", "dim_date", "date_key")
    + _nn("gold", "mart_daily_sales", "date_key") + _u("gold", "mart_daily_sales", "date_key")
)

SINGULAR = [
    Check("gold", "fact_orders", "expression", ("order_id",), name="delivery_not_before_purchase"),
    Check("gold", "fact_orders", "expression", ("order_id",), name="non_negative_order_amounts"),
]

CHECKS: list[Check] = BRONZE + SILVER + GOLD + SINGULAR

FRESHNESS_SOURCES = tuple(c.name for c in CONTRACTS)


def delivery_before_purchase(fact_orders: DataFrame) -> DataFrame:
    return q.expression(fact_orders,
                        F.col("delivered_to_customer_at") < F.col("purchased_at"), "order_id")


def negative_amounts(fact_orders: DataFrame) -> DataFrame:
    return q.expression(fact_orders,
                        (F.col("item_value") < 0) | (F.col("freight_value") < 0)
                        | (F.col("payment_value") < 0), "order_id")


SINGULAR_FN = {"delivery_not_before_purchase": delivery_before_purchase,
               "non_negative_order_amounts": negative_amounts}


def with_limits(checks: Iterable[Check], limits: Mapping[str, Mapping[str, object]]) -> list[Check]:
    """The checks, those that ``limits`` names with another severity, warn_above
    or error_above."""
    known = list(checks)
    unknown = set(limits) - {c.test_name for c in CHECKS}
    if unknown:
        raise KeyError(f"no such tests: {sorted(unknown)}")
    return [replace(c, **limits.get(c.test_name, {})) for c in known]


def trend(results: DataFrame) -> DataFrame:
    """Stored results, each with the failures of the test's run before, the
    change, and since how many runs the test has not passed."""
    by_run = Window.partitionBy("layer", "table_name", "test_name").orderBy("tested_at", "run_id")
    passed = F.count_if(F.col("status") == "pass").over(by_run)
    return (results.withColumns({"failures_before": F.lag("failures").over(by_run), "passed": passed})
            .withColumn("runs_not_passed", F.count_if(F.col("status") != "pass").over(
                Window.partitionBy("layer", "table_name", "test_name", "passed").orderBy("tested_at", "run_id")))
            .select("run_id", "layer", "table_name", "test_name", "severity", "status", "failures",
                    "failures_before", (F.col("failures") - F.col("failures_before")).alias("change"),
                    "runs_not_passed", "tested_at"))


def violations(check: Check, tables: Mapping[str, DataFrame], partitions: int | None = None) -> DataFrame:
    """The rows that the test returns; ``partitions`` as in ``quality.unique``."""
    df = tables[check.table]
    if check.kind == "not_null":
        return q.not_null(df, check.columns[0])
    if check.kind == "unique":
        return q.unique(df, check.columns, partitions)
    if check.kind == "accepted_values":
        return q.accepted_values(df, check.columns[0], check.values)
    if check.kind == "relationships":
        parent, fld = check.parent
        return q.relationships(df, check.columns[0], tables[parent], fld)
    if check.kind == "expression":
        return SINGULAR_FN[check.name](df)
    raise ValueError(check.kind)


def select(layer: str | Iterable[str] | None = None, kind: str | None = None,
           table: str | None = None) -> list[Check]:
    """Checks by layer tag / kind / table (``None`` = all)."""
    layers = {layer} if isinstance(layer, str) else (set(layer) if layer else None)
    return [c for c in CHECKS
            if (layers is None or c.layer in layers)
            and (kind is None or c.kind == kind)
            and (table is None or c.table == table)]


def _failures(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    # Failures = rows the test returns (for unique / accepted_values: the
    # offending values, each with its n_records).
    if check.kind == "relationships":
        parent, fld = check.parent
        found = q.orphans(tables[check.table], check.columns[0], tables[parent], fld)
        return found.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("failures"))
    return violations(check, tables).agg(F.count(F.lit(1)).alias("failures"))


# Bits of a key's hash: few enough to be small in a shuffle; of n keys about
# n * n / 2**41 pairs have one hash without being equal and are then told apart.
HASH_BITS = 40


def _unique_failures(tables: Mapping[str, DataFrame], checks: list[Check]) -> list[DataFrame]:
    """The unique tests, by suspects.  All rows of all tables go through one
    aggregation of (test, hash of the key), which a map task reduces first: a
    few bytes for a key, however wide it is.  Only rows whose hash
    repeats, of tests that have any, are then grouped by the key itself."""
    def keyed(c: Check) -> tuple[Column, Column]:
        present = reduce(lambda x, y: x & y, [F.col(col).isNotNull() for col in c.columns])
        return present, F.shiftrightunsigned(F.xxhash64(*c.columns), 64 - HASH_BITS)

    number = {c.test_name: i for i, c in enumerate(checks)}
    stacked: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        by_table.setdefault(c.table, []).append(c)
    for table, group in by_table.items():
        entries = []
        for c in group:
            present, h = keyed(c)
            entries.append(F.when(present, F.struct(F.lit(number[c.test_name]).alias("test"), h.alias("h"))))
        stacked.append(tables[table].select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull()))))
    spark = stacked[0].sparkSession
    path = scratch_path(spark, "suspects")
    (reduce(DataFrame.unionByName, stacked).groupBy("test", "h").agg(F.count(F.lit(1)).alias("n"))
     .where("n > 1").select("test", "h").write.parquet(path))
    suspects = spark.read.parquet(path)
    some = {r[0] for r in suspects.select("test").distinct().collect()}     # at most one per test
    clean = [(c.layer, c.table, c.test_name, 0) for c in checks if number[c.test_name] not in some]
    schema = "layer string, table_name string, test_name string, failures bigint"
    parts = [spark.createDataFrame(clean, schema)] if clean else []
    for c in checks:
        if number[c.test_name] in some:
            present, h = keyed(c)
            own = suspects.where(F.col("test") == number[c.test_name]).select(F.col("h").alias("_suspect"))
            rows = (tables[c.table].where(present).select(*c.columns, h.alias("_h"))
                    .join(own, F.col("_h") == F.col("_suspect"), "left_semi"))
            parts.append(q.unique(rows, c.columns).agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.layer).alias("layer"), F.lit(c.table).alias("table_name"),
                F.lit(c.test_name).alias("test_name"), "failures"))
    return parts


def summary(tables: Mapping[str, DataFrame], checks: list[Check] | None = None,
            in_buckets: Mapping[str, str] | None = None) -> DataFrame:
    """One row per check: layer, table_name, test_name, failures.

    Not-null tests of one table are measured together in one aggregate pass;
    unique tests of all tables in one aggregation that runs at once, for their
    suspects; the other kinds are one aggregation or anti join each.  The rest is
    one union, executed as one job.  ``in_buckets`` names tables that lie in
    buckets of a column: unique tests of keys with it are grouped in place.
    """
    checks = CHECKS if checks is None else checks
    parts: list[DataFrame] = []
    by_table: dict[tuple[str, str], list[Check]] = {}
    for c in checks:
        if c.kind == "not_null":
            by_table.setdefault((c.layer, c.table), []).append(c)
    for (layer, table), group in by_table.items():
        cols = [c.columns[0] for c in group]
        counts = q.null_counts(tables[table], cols)
        stacked = F.explode(F.array(*[
            F.struct(F.lit(c.test_name).alias("test_name"),
                     F.col(c.columns[0]).cast("bigint").alias("failures"))
            for c in group])).alias("t")
        parts.append(counts.select(stacked).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
            "t.test_name", "t.failures"))
    uniques = [c for c in checks if c.kind == "unique" and (in_buckets or {}).get(c.table) not in c.columns]
    if uniques:
        parts += _unique_failures(tables, uniques)
    for c in checks:
        if c.kind == "not_null" or c in uniques:
            continue
        parts.append(_failures(c, tables).select(
            F.lit(c.layer).alias("layer"), F.lit(c.table).alias("table_name"),
            F.lit(c.test_name).alias("test_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def freshness_report(tables: Mapping[str, DataFrame], sources=FRESHNESS_SOURCES,
                     now=None) -> DataFrame:
    parts = [q.freshness(tables[t], LOADED_AT, now=now)
             .select(F.lit(t).alias("table_name"), "max_loaded_at", "status")
             for t in sources]
    return reduce(DataFrame.unionByName, parts)
