"""The registered queries: complete, and equal to their SQL on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences, duckdb_over
from checks.oracle import ORACLE
from checks.queries import QUERIES

DATA = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not Path(DATA).is_dir(), reason="test tables not present")

# One query per kind of operator; the rest are compared by `checks.compare`.
SAMPLE = [
    "po_tracking_mtd",
    "blank_fallback",
    "tax_split",
    "or_across_tables",
    "conditional_window_closed",
    "null_safe_exclude",
    "not_in_anti",
    "composite_key_join",
    "top1_correlated",
    "top1_global_history",
    "approval_pivot",
    "bonus_rollup_since",
    "sink_month_partition",
    "sink_month_rerun",
    "po_tracking_mtd_skewed",
    "so_tracking_inquiry_skewed",
    "po_tracking_mtd_ignore_case",
]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(DATA)


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_same_as_sql(spark, connection, name):
    found = differences(queries()[name](spark, DATA), connection, oracle_sql()[name])
    assert found is None, found


@needs_data
def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 22 and not df.isEmpty()
