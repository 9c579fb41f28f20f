"""Top-1-per-key operators.

``latest_by`` keeps the newest row per key: ``row_number()`` over the key,
newest load first and the last file row breaking ties, then ``rank = 1``.
Catalyst plans this as ``WindowGroupLimit`` on both sides of the exchange, so
every map task already reduces a key to one row before the shuffle; a key that
holds a large share of all rows (hot key, or the NULL key, which forms one
group) is cut down map-side instead of landing whole in one reducer.

``pick_by_priority`` is the same shape for "first source that has the key".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.contracts import LOADED_AT, SOURCE_ROW

_RANK = "_row_rank"


def latest_by(df: DataFrame, keys: Sequence[str],
              order: Sequence[str] = (LOADED_AT, SOURCE_ROW)) -> DataFrame:
    """One row per ``keys`` value, the one with the greatest ``order`` tuple.

    The key is taken as given (raw values), so ``' a'`` and ``'a'`` are two keys.
    For a deterministic result the ``order`` columns must be a total order within
    each key; the lineage columns (load time, file row number) are.
    """
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in order])
    return (df.withColumn(_RANK, F.row_number().over(window))
              .where(F.col(_RANK) == 1)
              .drop(_RANK))


def pick_by_priority(df: DataFrame, keys: Sequence[str],
                     priority: str = "source_priority") -> DataFrame:
    """The row of the lowest ``priority`` per key (priority column dropped)."""
    window = Window.partitionBy(*keys).orderBy(F.col(priority).asc_nulls_last())
    return (df.withColumn(_RANK, F.row_number().over(window))
              .where(F.col(_RANK) == 1)
              .drop(_RANK, priority))
