"""Data-quality operators.  Each check returns the violating rows as a
DataFrame (empty = pass), so a check is lazy, composable and distributed.

At scale the suite does not run one job per test: ``null_counts`` measures every
not-null column of a table in a single aggregate pass, and ``unique`` /
``relationships`` are one aggregation / one anti-join each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Freshness limits of the raw sources.
WARN_AFTER_HOURS = 12
ERROR_AFTER_HOURS = 24


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the NULL count of each column, in one pass over ``df``."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def unique(df: DataFrame, columns: Sequence[str] | str, partitions: int | None = None) -> DataFrame:
    """Key values that occur more than once (``n_records`` = occurrences).

    Rows with a NULL in the key are ignored.  Works for one column or a
    composite key; for a composite it is the same test as uniqueness of the
    ``a || '-' || b`` string, without building the string.

    ``partitions`` deals the rows by their key into so many tasks, which AQE
    does not merge: for rows of nearly distinct keys, whose counts take far more
    memory than their few shuffled bytes let AQE expect.  Without it rows are
    counted before the shuffle, as a key that many rows hold needs.
    """
    cols = [columns] if isinstance(columns, str) else list(columns)
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    rows = df.where(present)
    if partitions:
        rows = rows.select(*cols).repartition(partitions, *cols)
    return (rows.groupBy(*cols)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the accepted list with their counts; NULL passes."""
    return (df.where(~F.col(column).isin(*list(values)))
              .groupBy(F.col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no ``field`` match in ``parent``.

    A left anti join: it never multiplies rows, and needs no distinct on the
    parent side.
    """
    keys = parent.select(F.col(field).alias("_parent_key"))
    return (child.where(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """The values that ``relationships`` finds, with the rows that hold each
    (``n_records``).  The child is aggregated before the join, so that a value
    that many rows hold is one row in it."""
    held = (child.where(F.col(column).isNotNull()).groupBy(column)
                 .agg(F.count(F.lit(1)).alias("n_records")))
    return relationships(held, column, parent, field)


def expression(df: DataFrame, violation: Column, *select: str) -> DataFrame:
    """Rows for which ``violation`` is true (a singular business assertion)."""
    out = df.where(violation)
    return out.select(*select) if select else out


def freshness(df: DataFrame, loaded_at: str = "_loaded_at",
              warn_hours: int = WARN_AFTER_HOURS, error_hours: int = ERROR_AFTER_HOURS,
              now: dt.datetime | None = None) -> DataFrame:
    """One row: newest load time and ``pass`` / ``warn`` / ``error`` by age."""
    now_col = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    newest = F.max(F.col(loaded_at).cast("timestamp"))
    return df.agg(newest.alias("max_loaded_at")).select(
        "max_loaded_at",
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(F.col("max_loaded_at") < now_col - F.expr(f"INTERVAL {error_hours} HOURS"),
               F.lit("error"))
         .when(F.col("max_loaded_at") < now_col - F.expr(f"INTERVAL {warn_hours} HOURS"),
               F.lit("warn"))
         .otherwise(F.lit("pass")).alias("status"))


def row_count_match(expected: int, actual: int, what: str = "") -> None:
    """Raise when a loaded count differs from the expected one."""
    if expected != actual:
        raise ValueError(f"Row-count mismatch{' for ' + what if what else ''}: "
                         f"expected {expected}, loaded {actual}")


def parse_failures(raw: DataFrame, parsers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row: per raw column, the rows whose raw value is present but does
    not parse (the value would silently become NULL).  One pass over ``raw``."""
    return raw.agg(*[F.count_if(F.col(c).isNotNull() & parse(F.col(c)).isNull()).alias(c)
                     for c, parse in parsers.items()])
