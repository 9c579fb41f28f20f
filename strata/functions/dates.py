"""Date and calendar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.clean import _col


def date_key(c) -> Column:
    """Integer ``YYYYMMDD`` key of a date or timestamp, built arithmetically
    (no string formatting on the hot path)."""
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def days_between(start, end) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (a timestamp
    at 23:59:59 and one at 00:00:01 the next day are one day apart)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def iso_day_of_week(c) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_col(c)) + 1).cast("int")


def calendar_attributes(day) -> list[Column]:
    """The calendar dimension's attribute columns for a date column."""
    d = _col(day)
    dow = iso_day_of_week(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("date_day"),
        F.year(d).cast("int").alias("year_number"),
        F.quarter(d).cast("int").alias("quarter_number"),
        F.month(d).cast("int").alias("month_number"),
        F.monthname(d).alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
    ]
