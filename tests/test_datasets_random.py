"""Every dataset against the plain join chain, on random tables with awkward ids."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import types as T

from checks import oracle
from checks.compare import differences
from checks.money import money_on_grid
from checks.queries import AMOUNTS, WIDE_AMOUNTS
from orderweave.functions.windows import DateWindow
from orderweave.plans import (
    Stages,
    po_tracking_by_delivery,
    po_tracking_month,
    so_tracking_inquiry,
    so_tracking_no_inquiry,
)
from orderweave.sources import Tables

from .random_tables import write_tables

MONTH = ("2024-12-01", "2025-01-01")
WINDOW = DateWindow(*MONTH)

DATASETS = {
    "month": (
        lambda t, salts, **more: money_on_grid(
            po_tracking_month(t, WINDOW, created=DateWindow("2024-11-01", "2025-01-01"), salts=salts, **more),
            *AMOUNTS,
        ),
        None,
    ),
    "by_delivery": (
        lambda t, salts, **more: money_on_grid(
            po_tracking_by_delivery(t, WINDOW, DateWindow("2024-12-05", "2025-01-01"), salts=salts, **more),
            *AMOUNTS,
        ),
        oracle.po_tracking_by_delivery_sql(*MONTH, "2024-12-05", "2025-01-01"),
    ),
    "inquiry": (
        lambda t, salts, **more: money_on_grid(
            so_tracking_inquiry(t, DateWindow(*MONTH, closed=True), salts=salts, **more),
            "decAmountPOSO",
            *WIDE_AMOUNTS,
        ),
        oracle.so_tracking_inquiry_sql(*MONTH),
    ),
    "no_inquiry": (
        lambda t, salts, **more: money_on_grid(so_tracking_no_inquiry(t, WINDOW, salts=salts, **more), *WIDE_AMOUNTS),
        oracle.so_tracking_no_inquiry_sql(*MONTH),
    ),
}
MONTH_SQL = oracle.po_tracking_month_sql(*MONTH).replace(
    f"so.dtmCreated >= timestamp '{MONTH[0]}'", "so.dtmCreated >= timestamp '2024-11-01'"
)


#: Whether joins are salted, and ids of how many rows count as heavy with stages (None: without stages).
MODES = {"plain": (None, None), "split": (5, None), "staged": (None, 500_000), "staged, every repeated id heavy": (5, 1)}


@pytest.fixture(params=list(MODES))
def mode(request, spark):
    salts, heavy = MODES[request.param]
    if salts:
        # No broadcast, so that every join is salted where its keys are blank or heavy.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield salts, heavy
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _check(spark, root, dataset, mode, seed, **shape):
    connection = duckdb.connect()
    for name, path in write_tables(root, seed, **shape).items():
        connection.execute(f"create table erp_{name} as select * from read_parquet('{path}')")
    build, sql = DATASETS[dataset]
    tables = Tables.parquet(spark, str(root), money=T.DoubleType())
    assert connection.execute(sql or MONTH_SQL).fetchone() is not None
    salts, heavy = mode
    more = {} if heavy is None else {"stages": Stages(spark, heavy_rows=heavy)}
    found = differences(build(tables, salts, **more), connection, sql or MONTH_SQL)
    assert found is None, found


# Chosen so that every dataset has rows.
SHAPES = {
    "many blanks": {"seed": 14},
    "some blanks": {"seed": 3, "rows": 24, "ids": 20},
    "no blanks": {"seed": 7, "rows": 30, "ids": 24, "blank": 0.0},
}


@pytest.mark.parametrize("dataset", list(DATASETS))
def test_same_as_plain_chain(spark, tmp_path, mode, dataset):
    _check(spark, tmp_path, dataset, mode, **SHAPES["some blanks"])


@pytest.mark.parametrize("dataset", list(DATASETS))
@pytest.mark.parametrize("shape", ["many blanks", "no blanks"])
def test_other_shapes(spark, tmp_path, dataset, shape):
    _check(spark, tmp_path, dataset, MODES["staged" if shape == "many blanks" else "plain"], **SHAPES[shape])
