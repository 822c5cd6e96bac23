from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderweave.functions import business as b
from orderweave.functions import nulls as n
from orderweave.functions.windows import DateFloor, DateWindow, last_months, month_to_date


def values(spark, schema, rows, *columns):
    """The given expressions over literal rows."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    picked = [c.alias(f"c{k}") for k, c in enumerate(columns)]
    out = [tuple(r)[1:] for r in df.select("i", *picked).orderBy("i").collect()]
    return [r[0] for r in out] if len(columns) == 1 else out


def test_blank_tests(spark):
    rows = [(None,), ("",), ("  ",), (" x ",)]
    c = F.col("s")
    assert values(spark, "s string", rows, n.is_blank(c)) == [True, True, True, False]
    assert values(spark, "s string", rows, n.is_empty(c)) == [None, True, True, False]
    assert values(spark, "s string", rows, n.is_empty_id(c)) == [None, True, True, False]
    assert values(spark, "s string", rows, n.not_empty(c)) == [None, False, False, True]
    assert values(spark, "s string", rows, n.trimmed(c)) == ["", "", "", "x"]


def test_defaults_keep_the_type(spark):
    df = spark.createDataFrame(
        [(None, None, None, None)], "t timestamp_ntz, s string, q decimal(18,4), f boolean"
    ).select(
        n.date_or_default(F.col("t")).alias("t"),
        n.date_or_parts(F.col("t")).alias("p"),
        n.text_or_default(F.col("s")).alias("s"),
        n.number_or_zero(F.col("q")).alias("q"),
        n.flag_or_false(F.col("f")).alias("f"),
    )
    types = dict(df.dtypes)
    assert types == {
        "t": "timestamp_ntz", "p": "timestamp_ntz", "s": "string", "q": "decimal(18,4)", "f": "boolean"
    }
    start = datetime(1900, 1, 1)
    assert tuple(df.first()) == (start, start, "", Decimal("0.0000"), False)


def test_order_number(spark):
    rows = [(None, "PO1"), ("  ", "PO1"), (" CP ", "PO1"), ("", None)]
    number = b.order_number(F.col("c"), F.col("p"))
    assert values(spark, "c string, p string", rows, number) == ["PO1", "PO1", "CP", None]


def test_source_switches(spark):
    rows = [(None,), (" ",), ("SO1",)]
    by_so = b.by_sales_order(F.col("s"), F.lit("purchase"), F.lit("sales"))
    by_po = b.by_purchase_order(F.col("s"), F.lit("without"), F.lit("with"))
    assert values(spark, "s string", rows, by_so) == ["purchase", "purchase", "sales"]
    assert values(spark, "s string", rows, by_po) == ["with", "without", "with"]


def test_reserved_orders(spark):
    rows = [(None,), ("RES0-1",), ("XRES2",), ("RESX",), ("CP1",)]
    keep = b.contains_none(F.col("s"), ("RES0", "RES1", "RES2"))
    assert values(spark, "s string", rows, keep) == [None, False, False, True, True]


@pytest.mark.parametrize("money", ["double", "decimal(18,4)"])
def test_tax_split(spark, money):
    schema = "amount string, taxable boolean, net string, tax string"
    rows = [("11", True, "100", "10"), ("11", True, "0", "0"), ("11", False, "100", "10"), ("11", None, "1", "1")]
    amount, net, tax = (F.col(x).cast(money) for x in ("amount", "net", "tax"))
    taxed = (F.col("taxable"), net, tax)
    out = values(
        spark, schema, rows, b.discount_net(amount, *taxed), b.discount_tax(amount, *taxed),
        b.net_price(amount, *taxed),
    )
    assert [tuple(float(x) for x in r) for r in out] == [(10, 1, 10), (11, 0, 11), (11, 0, 11), (11, 0, 11)]


def test_net_amount(spark):
    rows = [(10.0, None, 2.0), (10.0, 3.0, 2.0), (None, 1.0, 1.0)]
    total = b.net_amount(F.col("a"), F.col("x"), F.col("y"))
    assert values(spark, "a double, x double, y double", rows, total) == [8.0, 5.0, None]


def test_quantities(spark):
    rows = [("DN1", 5.0), ("DN1", None), (" ", 5.0), (None, 5.0)]
    present = b.quantity_if_present(F.col("d"), F.col("q"))
    assert values(spark, "d string, q double", rows, present) == [5.0, 0.0, 0.0, 0.0]
    rows = [(0.0, 12.0), (5.0, 60.0), (None, 60.0)]
    units = b.quantity_or_units(F.col("q"), F.col("u"))
    assert values(spark, "q double, u double", rows, units) == [12.0, 5.0, None]


def test_replaced(spark):
    rows = [(None,), ("",), ("IV9",)]
    chosen = b.replaced(F.col("h"), F.lit("IV1"), F.col("h"))
    assert values(spark, "h string", rows, chosen) == ["IV1", "IV1", "IV9"]


def test_approval_levels(spark):
    schema = "applied boolean, void boolean, level tinyint"
    rows = [
        (True, False, 2), (False, True, 2), (False, False, 2), (False, False, None),
        (None, None, None), (None, False, 2), (None, True, 2),
    ]
    args = (F.col("applied"), F.col("void"), F.col("level"))
    assert values(spark, schema, rows, b.approval_level(*args)) == ["", "", "3", "1", "1", "3", ""]
    unlinked = values(spark, schema, rows, b.approval_level_unlinked(*args))
    assert unlinked == ["", "", "1", "1", "1", "3", ""]


def test_joined_key(spark):
    rows = [(None, "P1"), ("PO1", None), ("PO1", "P1")]
    key = b.joined_key(F.col("a"), F.col("b"))
    assert values(spark, "a string, b string", rows, key) == ["-P1", "PO1-", "PO1-P1"]


def test_window_ends(spark):
    rows = [(datetime(2024, 12, 1),), (datetime(2024, 12, 31, 23),), (datetime(2025, 1, 1),), (None,)]
    half_open = DateWindow("2024-12-01", "2025-01-01")
    closed = DateWindow("2024-12-01", "2025-01-01", closed=True)
    c = F.col("d")
    assert values(spark, "d timestamp_ntz", rows, half_open.contains(c)) == [True, True, False, None]
    assert values(spark, "d timestamp_ntz", rows, closed.contains(c)) == [True, True, True, None]
    at_floor = DateFloor("2024-12-01")
    after = DateFloor("2024-12-01", inclusive=False)
    assert values(spark, "d timestamp_ntz", rows, at_floor.admits(c))[0] is True
    assert values(spark, "d timestamp_ntz", rows, after.admits(c))[0] is False


def test_month_windows():
    assert month_to_date(date(2024, 12, 15)) == DateWindow("2024-12-01", "2025-01-01")
    assert last_months(date(2025, 1, 31), 3) == DateWindow("2024-11-01", "2025-02-01")
