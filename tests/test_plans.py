"""What the physical plans of the datasets must look like at any size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderweave.functions.windows import DateWindow
from orderweave.plans import (
    po_tracking_by_delivery,
    po_tracking_month,
    so_tracking_inquiry,
    so_tracking_no_inquiry,
)
from orderweave.sources import Tables
from orderweave.sources.schema import COLUMNS

from .random_tables import write_tables

MONTH = DateWindow("2024-12-01", "2025-01-01")
BUILD = {
    "month": lambda t: po_tracking_month(t, MONTH),
    "by_delivery": lambda t: po_tracking_by_delivery(t, MONTH, MONTH),
    "inquiry": lambda t: so_tracking_inquiry(t, MONTH),
    "no_inquiry": lambda t: so_tracking_no_inquiry(t, MONTH),
}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark, tmp_path):
    """Tables without blank documents, planned as if none could be broadcast."""
    write_tables(tmp_path, seed=7, rows=30, ids=24, blank=0.0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Tables.parquet(spark, str(tmp_path), money=T.DoubleType())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("dataset", list(BUILD))
def test_no_pairwise_join_and_no_python(large, dataset):
    plan = physical(BUILD[dataset](large))
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "SinglePartition"):
        if dataset == "no_inquiry" and unwanted == "SinglePartition":
            continue  # the two scalar counts of the anti join
        if dataset == "inquiry" and unwanted == "SinglePartition":
            continue  # the single latest history row
        assert unwanted not in plan, unwanted
    # The only hints are on frames of bounded size: a top-1 row or a handful of looked-up rows.
    assert plan.count("BroadcastExchange") <= (4 if dataset == "inquiry" else 0)


def test_month_ends_without_another_shuffle(spark, large):
    """After the items have met their order nothing moves: not for discounts, products, DISTINCT."""
    frames = {name: large[name] for name in COLUMNS}
    frames["product"] = F.broadcast(frames["product"])
    lines = physical(BUILD["month"](Tables.from_frames(spark, frames))).splitlines()
    # A node is printed before its left input, so the lines above the item join are its ancestors.
    # The first branch is that of the inquiries with a sales order.
    join, *_ = [i for i, line in enumerate(lines) if "[soi_so#" in line and "SortMergeJoin" in line and "si_so#" in line]
    above = "\n".join(lines[:join])
    assert "Exchange" not in above and above.count("HashAggregate") == 2
    assert "BroadcastHashJoin" in above and "bonus_so" in above


def test_filters_and_columns_reach_the_scan(large):
    plan = BUILD["month"](large)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    purchases = next(line for line in scans if "dtmPO" in line)
    assert "GreaterThanOrEqual(dtmPO" in purchases and "LessThan(dtmPO" in purchases
    assert "ReadSchema" in purchases and "szStatus" not in purchases
    orders = next(line for line in scans if "szCustPoId" in line)
    assert "GreaterThanOrEqual(dtmCreated" in orders and "szFDoReffId" not in orders


@pytest.mark.parametrize("dataset", list(BUILD))
def test_building_a_plan_starts_no_job(spark, large, dataset):
    context = spark.sparkContext
    context.setJobGroup(f"build {dataset}", "")
    try:
        BUILD[dataset](large)
        assert not context.statusTracker().getJobIdsForGroup(f"build {dataset}")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
