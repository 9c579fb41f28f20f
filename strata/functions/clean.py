"""Column functions used to type and clean raw string columns.

Each function maps Column -> Column and stays a built-in Catalyst expression, so
it is code-generated inside the surrounding stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The tokens the landing format reads as NULL.
NULL_TOKENS = ("", "NULL", "null")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c) -> Column:
    """Landing rule: an empty field and the NULL tokens become NULL."""
    c = _col(c)
    return F.when(~c.isin(*NULL_TOKENS), c)


def blank_to_null(c) -> Column:
    """``nullif(trim(c), '')``: strip spaces, blank becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def zip5(c) -> Column:
    """Left-pad to five characters with zeros; longer values stay whole (cut,
    two of them could become one)."""
    value = blank_to_null(c)
    return F.when(F.length(value) < 5, F.lpad(value, 5, "0")).otherwise(value)


def upper_code(c) -> Column:
    return F.upper(blank_to_null(c))


def lower_code(c) -> Column:
    return F.lower(blank_to_null(c))


def parse_int(c) -> Column:
    """Integer parse through decimal(38,0): '12.5' rounds half up to 13, bad
    text and out-of-range values give NULL."""
    return _col(c).try_cast(DecimalType(38, 0)).try_cast("bigint")


def parse_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """Fixed-point parse; overflow or bad text gives NULL."""
    return _col(c).try_cast(DecimalType(precision, scale))


def parse_double(c) -> Column:
    return _col(c).try_cast("double")


def parse_timestamp(c) -> Column:
    """Zone-less timestamp parse; bad text gives NULL."""
    return _col(c).try_cast("timestamp_ntz")


def key_concat(*cols) -> Column:
    """String key built with ``a || '-' || b``: NULL if any part is NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)
