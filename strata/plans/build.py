"""Full refresh of the warehouse: Bronze -> Silver -> Gold, each layer written
as new versions, tested, and published atomically before the next layer reads
it.

Every model is computed once and written to the shared warehouse root; the
next layer reads the written copy, which cuts the lineage (an executor lost
later never forces a recomputation from raw data) and lets every downstream
model and every test scan a compact Parquet table.  Independent models of a
layer are submitted concurrently from a small driver pool.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import date_key
from strata.plans import gold as gold_models
from strata.plans import suite
from strata.plans.buckets import (ROWS_PER_PIECE, Buckets, cut_hot, number, number_for, piece, settings,
                                  whole_pieces)
from strata.plans.layers import DESCRIPTIONS, GOLD, ORDER_MODELS, PARTITION_BY, SILVER, Layers
from strata.plans.silver import ORDER, typed, with_order
from strata.sources.catalog import now_utc
from strata.sources.catalog import Catalog
from strata.sources.contracts import contract

# Gold models whose written inputs lie in buckets or can be read twice: the same rows by less shuffling.
IN_PLACE = {
    "fact_orders": partial(gold_models.fact_orders, metrics_of_items=gold_models.item_metrics_in_place),
    "mart_daily_sales": partial(gold_models.mart_daily_sales, by_day=gold_models.daily_sales_in_two),
}

# The piece of a month that a fact's row is written with.
PIECE = "_piece"

# Gold models in dependency waves (a wave only reads earlier waves).
GOLD_WAVES = (
    ("dim_customer", "dim_seller", "dim_product", "dim_product_category", "dim_geography",
     "dim_date", "fact_orders", "fact_order_items"),
    ("mart_daily_sales",),
)


@dataclass
class BuildResult:
    run_id: str
    published: dict[str, int] = field(default_factory=dict)        # layer -> manifest seq
    failures: dict[str, list[tuple[str, int]]] = field(default_factory=dict)
    buckets: int = 1                  # of the written Silver order tables, by their order id


class GateFailed(AssertionError):
    pass


def _gate(catalog: Catalog, tables: Mapping[str, DataFrame], layer: str, on_failure: str,
          result: BuildResult, freshness_now=None, check_freshness: bool = False,
          limits: Mapping[str, Mapping[str, object]] | None = None,
          in_buckets: Mapping[str, str] | None = None) -> None:
    """Run the layer's tests (one job; ``in_buckets`` as in ``suite.summary``),
    store every result with its severity, and stop the build when asked to if a
    test fails: one of error severity with more failures than its limit.

    For Bronze, source freshness follows the tests (newest load older than
    12 h warns, older than 24 h is an error), as the source pipeline orders it.
    """
    if on_failure == "skip":
        return
    checks = {c.test_name: c for c in suite.with_limits(suite.select(layer), limits or {})}
    rows = suite.summary(tables, list(checks.values()), in_buckets).collect()      # one row per declared test
    at = now_utc()
    records, failed = [], []
    for r in sorted(rows, key=lambda r: r["test_name"]):
        check, n = checks[r["test_name"]], int(r["failures"])
        records.append((result.run_id, r["layer"], r["table_name"], check.test_name, check.severity, n,
                        check.status(n), at))
        if check.status(n) == "fail":
            failed.append((check.test_name, n))
    if check_freshness:
        for r in suite.freshness_report(tables, now=freshness_now).collect():   # one row per source
            name = f"freshness:{r['table_name']}._loaded_at"
            status = {"pass": "pass", "warn": "warn"}.get(r["status"], "fail")
            records.append((result.run_id, layer, r["table_name"], name, "error",
                            0 if status == "pass" else 1, status, at))
            if status == "fail":
                failed.append((name, 1))
    catalog.append_test_results(records)
    result.failures[layer] = failed
    if failed and on_failure == "raise":
        lines = "\n".join(f"- {t}: {n}" for t, n in failed)
        raise GateFailed(f"Layer {layer!r} failed its tests; later layers not built:\n{lines}")


def _write_layer(spark: SparkSession, catalog: Catalog, layer: str,
                 frames: Mapping[str, DataFrame], version: str, parallelism: int,
                 buckets: Buckets | None = None,
                 months: Mapping[str, Mapping[int | None, float]] | None = None) -> dict[str, DataFrame]:
    """Write ``frames`` as versions and return the written copies.  With
    ``buckets``, the order models lie in buckets of their order id, and the facts
    are put together by month (about so many rows in ``months``) in a staged
    table, not by a shuffle."""
    def write(name: str) -> tuple[str, DataFrame]:
        df, part = frames[name], PARTITION_BY.get(name)
        if buckets and name in ORDER_MODELS:
            return name, buckets.write(df, catalog.version_path(layer, name, version), "order_id")
        if part:
            df = df.withColumn(part, (F.col("order_date_key") / 100).cast("int"))
        if part and buckets:
            cut = df.withColumn(PIECE, piece(months[name], F.col(part), F.col("order_id")))
            n = number(spark, sum(months[name].values()), ROWS_PER_PIECE)
            df = whole_pieces(buckets.stage(cut, name, PIECE, n), PIECE)
        path = catalog.write_version(df, layer, name, version, partition_by=[part] if part else None,
                                     rebalance=not buckets)
        if part and buckets:
            buckets.unstage(name)
        return name, spark.read.parquet(path)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return dict(pool.map(write, list(frames)))


def _staged_orders(bronze: Mapping[str, DataFrame], buckets: Buckets, parallelism: int) -> dict[str, DataFrame]:
    """The raw order tables, typed and written in buckets of their cleaned order id."""
    def stage(model: str) -> tuple[str, DataFrame]:
        raw = SILVER[model][1]
        rows = cut_hot(typed(bronze[raw], raw), contract(raw).key)
        return raw, buckets.stage(with_order(rows), raw, ORDER)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return dict(pool.map(stage, ORDER_MODELS))


def _rows_by_month(silver: Mapping[str, DataFrame]) -> dict[str, dict[int | None, float]]:
    """About how many rows of each fact a month has: its orders, and as many
    lines for each as orders have on average."""
    orders = {r[0]: r[1] for r in silver["stg_orders"].groupBy(      # a row for each month
        (date_key("purchased_at") / 100).cast("int")).count().collect()}
    lines = silver["stg_order_items"].count() / max(1, sum(orders.values()))
    return {"fact_orders": orders, "fact_order_items": {m: n * lines for m, n in orders.items()}}


def build(spark: SparkSession, catalog: Catalog, bronze: Mapping[str, DataFrame],
          on_failure: str = "raise", run_id: str | None = None,
          parallelism: int = 8, check_freshness: bool = True, freshness_now=None,
          limits: Mapping[str, Mapping[str, object]] | None = None) -> BuildResult:
    """Build, test and publish Silver then Gold.

    ``on_failure="raise"`` stops at the first layer whose tests fail (nothing
    of that layer is published); ``"warn"`` records the failures and goes on;
    ``"skip"`` runs no tests (the caller runs the suite itself).
    ``check_freshness`` adds source freshness to the Bronze gate (on by
    default, as in the source pipeline); ``freshness_now`` fixes its clock.
    ``limits`` gives tests another severity or limits of their own for this
    build: {test name: {"severity": .., "warn_above": .., "error_above": ..}}.
    """
    run_id = run_id or str(uuid.uuid4())
    result = BuildResult(run_id)

    bronze_tables = {name: bronze[name] for _, name in SILVER.values()}
    _gate(catalog, bronze_tables, "bronze", on_failure, result,
          freshness_now=freshness_now, check_freshness=check_freshness, limits=limits)

    buckets = Buckets(spark, number_for(bronze_tables[SILVER[m][1]] for m in ORDER_MODELS))
    result.buckets = buckets.n
    with settings(spark), buckets:
        base = Layers(bronze, overrides=_staged_orders(bronze, buckets, parallelism))
        silver = _write_layer(spark, catalog, "silver", {name: base[name] for name in SILVER}, run_id,
                              parallelism, buckets)
        for model in ORDER_MODELS:
            buckets.unstage(SILVER[model][1])
        _gate(catalog, silver, "silver", on_failure, result, limits=limits,
              in_buckets=dict.fromkeys(ORDER_MODELS, "order_id"))
        result.published["silver"] = catalog.publish(
            "silver", {name: (run_id, None) for name in silver}, publication_id=run_id,
            descriptions=DESCRIPTIONS)

        written: dict[str, DataFrame] = dict(silver)
        months = _rows_by_month(silver)
        for wave in GOLD_WAVES:
            layered = Layers(bronze, overrides=written)
            frames = {name: IN_PLACE[name](*[written[x] for x in GOLD[name][1]]) if name in IN_PLACE
                      else layered[name] for name in wave}
            written.update(_write_layer(spark, catalog, "gold", frames, run_id, parallelism, buckets, months))
    gold = {name: written[name] for name in GOLD}
    _gate(catalog, gold, "gold", on_failure, result, limits=limits)
    result.published["gold"] = catalog.publish(
        "gold", {name: (run_id, None) for name in gold}, publication_id=run_id,
        descriptions=DESCRIPTIONS)
    return result


def publish_frames(spark: SparkSession, catalog: Catalog, layer: str,
                   frames: Mapping[str, DataFrame], version: str | None = None,
                   parallelism: int = 8) -> dict[str, DataFrame]:
    """Write frames as versions of ``layer`` and publish them together; returns
    the written copies (e.g. to stage an already-parsed Bronze load)."""
    version = version or str(uuid.uuid4())
    written = _write_layer(spark, catalog, layer, frames, version, parallelism)
    catalog.publish(layer, {name: (version, None) for name in frames}, publication_id=version)
    return written


def published_tables(catalog: Catalog) -> dict[str, DataFrame]:
    """Every published Silver and Gold table, by name."""
    out: dict[str, DataFrame] = {}
    for layer in ("silver", "gold"):
        reader = catalog.reader(layer)
        for name in catalog.current(layer):
            out[name] = reader[name]
    return out
