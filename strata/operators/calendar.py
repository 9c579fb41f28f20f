"""Calendar spine: one row per day between two bounds.

The bounds arrive as a one-row DataFrame (a global aggregate, computed by
partial aggregation on every partition), and the days are generated with
``sequence`` + ``explode`` on that row: no global window, no cross join, no
driver round trip.  The whole span is generated: a calendar that stopped early
would drop the orders of the days it lacks from every model that joins it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import calendar_attributes

# The default span used when the order table gives no dates.
DEFAULT_START = dt.date(2016, 1, 1)
DEFAULT_END = dt.date(2018, 12, 31)


def date_spine(bounds: DataFrame, start: str = "min_date", end: str = "max_date") -> DataFrame:
    """Days ``start .. end``; no rows if end < start."""
    s, e = F.col(start), F.col(end)
    return bounds.select(F.explode(F.when(e >= s, F.sequence(s, e))).alias("date_day"))


def calendar(bounds: DataFrame, start: str = "min_date", end: str = "max_date") -> DataFrame:
    """Calendar dimension rows for the span in ``bounds``."""
    return date_spine(bounds, start, end).select(*calendar_attributes(F.col("date_day")))
