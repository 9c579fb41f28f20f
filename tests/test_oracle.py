"""Differential test: every registered query against its DuckDB oracle at
sf0.001 (row count, column names, order-free hash of all values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import compare  # noqa: E402

from small_data import SF_SMALL  # noqa: E402

NAMES = sorted(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    result = compare(spark, SF_SMALL, [name], verbose=False)[name]
    if name in E.oracle_sql():
        assert result is True
    else:
        assert result[0] == "rows-only" and result[1] >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "date_key" in df.columns
