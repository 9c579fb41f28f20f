"""Quality operators and the suite / gate."""

import datetime as dt

import pytest

from strata.operators import quality as q
from strata.plans import suite


def test_not_null_and_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, None)], "a int, b string")
    assert q.not_null(df, "b").count() == 2
    r = q.null_counts(df, ["a", "b"]).collect()[0]
    assert (r.a, r.b) == (1, 2)


def test_unique_ignores_nulls_and_handles_composites(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, n int")
    assert [(r.k, r.n_records) for r in q.unique(df, "k").collect()] == [("a", 3)]
    assert [(r.k, r.n, r.n_records) for r in q.unique(df, ["k", "n"]).collect()] == [("a", 1, 2)]


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,), (6,)], "s bigint")
    got = sorted((r.value, r.n_records) for r in q.accepted_values(df, "s", [1, 2, 3, 4, 5]).collect())
    assert got == [(0, 2), (6, 1)]


def test_relationships_anti_join(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "fk string")
    parent = spark.createDataFrame([("a",), ("a",)], "pk string")
    assert sorted(r.fk for r in q.relationships(child, "fk", parent, "pk").collect()) == ["b", "b"]


def test_freshness_levels(spark):
    now = dt.datetime(2024, 1, 2, 0, 0)
    for hours, status in ((1, "pass"), (13, "warn"), (30, "error")):
        df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "_loaded_at timestamp")
        assert q.freshness(df, now=now).collect()[0].status == status


def test_row_count_match():
    q.row_count_match(3, 3)
    with pytest.raises(ValueError, match="expected 3, loaded 2"):
        q.row_count_match(3, 2, "f.csv")


def test_suite_inventory():
    kinds = {}
    for c in suite.CHECKS:
        kinds[(c.layer, c.kind)] = kinds.get((c.layer, c.kind), 0) + 1
    assert len(suite.CHECKS) == 82
    assert kinds[("bronze", "not_null")] == 15 and kinds[("bronze", "unique")] == 5
    assert kinds[("silver", "not_null")] == 13 and kinds[("silver", "unique")] == 9
    assert kinds[("gold", "not_null")] == 16 and kinds[("gold", "unique")] == 10
    assert kinds[("gold", "relationships")] == 10 and kinds[("silver", "relationships")] == 1


def test_summary_and_gate(spark):
    good = spark.createDataFrame([("a", "u")], "customer_id string, customer_unique_id string")
    bad = spark.createDataFrame([("a", "u"), ("a", None)], "customer_id string, customer_unique_id string")
    checks = suite.select("silver", table="stg_customers")
    rows = {r.test_name: r.failures for r in suite.summary({"stg_customers": bad}, checks).collect()}
    assert rows == {"not_null:stg_customers.customer_id": 0,
                    "not_null:stg_customers.customer_unique_id": 1,
                    "unique:stg_customers.customer_id": 1}
    assert all(v == 0 for v in
               (r.failures for r in suite.summary({"stg_customers": good}, checks).collect()))


def test_unique_tests_by_suspects_equal_grouping(spark):
    """Single and composite keys, nulls, clean and dirty tests of two tables in one pass."""
    rows = [(i % 40, "a" if i % 3 else None, i) for i in range(90)] + [(None, "b", 1000), (None, "b", 1001)]
    tables = {"t": spark.createDataFrame(rows, "k int, s string, i int").repartition(3),
              "u": spark.createDataFrame([(i, f"{i % 2}") for i in range(10)], "k int, s string")}
    checks = [suite.Check("gold", t, "unique", columns) for t, columns in
              (("t", ("k",)), ("t", ("k", "s")), ("t", ("i",)), ("t", ("s", "i")), ("u", ("k",)), ("u", ("s",)))]
    got = {r.test_name: (r.layer, r.table_name, r.failures) for r in suite.summary(tables, checks).collect()}
    want = {c.test_name: ("gold", c.table, q.unique(tables[c.table], c.columns).count()) for c in checks}
    assert got == want
    assert [want[c.test_name][2] for c in checks] == [40, want["unique:t.k+s"][2], 0, 0, 0, 2]
    assert want["unique:t.k+s"][2] > 0
    clean = suite.summary(tables, [checks[2], checks[4]]).collect()
    assert [r.failures for r in clean] == [0, 0]
