from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderweave.operators import rollups
from orderweave.operators.joins import (
    anti_join_null_aware,
    flag_states,
    surviving_flags,
)
from orderweave.operators.ranking import highest, join_top_row, top_per_key, top_row
from orderweave.operators.skew import skew_join


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exclude_flagged(spark):
    orders = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "id string")
    flags = spark.createDataFrame(
        [("a", True), ("b", False), ("b", False), ("d", False), ("d", True), ("e", None), ("e", True)],
        "key string, flag boolean",
    )
    states = flag_states(flags, "key", "flag")
    out = surviving_flags(orders.join(states, F.col("id") == F.col("_flag_key"), "left"), "flag")
    assert rows(out) == [("b", False), ("c", None), ("d", False), ("e", None)]


@pytest.mark.parametrize(
    ("right", "expected"),
    [
        (["a", "c"], ["b"]),
        (["a", None], []),
        (["z", "z"], ["a", "b"]),
        ([], ["a", "b", None]),
    ],
)
def test_anti_join_null_aware(spark, right, expected):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([(r,) for r in right], "o string")
    out = anti_join_null_aware(left, other, "k", "o")
    assert sorted((r.k for r in out.collect()), key=str) == sorted(expected, key=str)


def test_anti_join_does_not_broadcast_the_subquery(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(10).withColumnRenamed("id", "k")
        out = anti_join_null_aware(left, spark.range(5).withColumnRenamed("id", "o"), "k", "o")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_closing(spark):
    day = datetime(2024, 12, 1)
    closings = spark.createDataFrame(
        [("d1", "c1", day, True), ("d1", "c2", datetime(2024, 12, 2), False), ("d2", "c3", None, True)],
        "dn string, id string, at timestamp_ntz, applied boolean",
    )
    out = top_per_key(closings, ["dn"], [F.desc_nulls_last("at"), F.asc("id")])
    assert rows(out.select("dn", "applied")) == [("d1", False), ("d2", True)]
    # One candidate per key and task goes into the shuffle.
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1)], "id string, level int")
    order = [F.desc_nulls_last("level"), F.asc("id")]
    assert rows(top_row(df, order)) == [("a", 3)]
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(join_top_row(left, df, ("k", "id"), order)) == [("a", "a", 3), ("b", None, None)]
    assert rows(highest(df.withColumn("k", F.lit("x")), "k", "level", "m")) == [("x", 3)]


# Roll-ups.

ITEM = "szFSoId string, shItemNumber short, szPrincipalDiscRefId string, bTaxable boolean, decDPP {m}, decTax {m}"
BONUS = (
    "szFSoId string, shItemNumber short, szProductId string, szParentId string, szPaymentType string,"
    " szOrderItemTypeId string, decBonusAmount {m}"
)


def frames(spark, items, bonuses, money="double"):
    convert = Decimal if money.startswith("decimal") else float
    items = [(*i[:4], *(None if x is None else convert(x) for x in i[4:])) for i in items]
    bonuses = [("S", 1, p, "R", "O", "JUAL", None if a is None else convert(a)) for p, a in bonuses]
    return (
        spark.createDataFrame(items, ITEM.format(m=money)),
        spark.createDataFrame(bonuses, BONUS.format(m=money)),
    )


def totals(df):
    return [tuple(None if r[n] is None else float(r[n]) for n in rollups.DISCOUNT_NAMES) for r in df.collect()]


@pytest.mark.parametrize("money", ["double", "decimal(18,4)"])
@pytest.mark.parametrize(
    ("reference", "expected"),
    [
        ("Invoice Disc. Item", (8, 0, 0, 0, 0, 0)),
        ("Invoice Disc. Item 2", (0, 0, 8, 8, 0, 0)),
        ("Invoice Disc.", (0, 0, 0, 0, 8, 8)),
        ("Other", (0, 0, 0, 0, 0, 0)),
        (None, (0, 0, 0, 0, 0, 0)),
    ],
)
def test_untaxed_items(spark, reference, expected, money):
    items, bonuses = frames(spark, [("S", 1, reference, False, "100", "10")], [("P", "8")], money)
    assert totals(rollups.bonus_rollup(items, bonuses)) == [expected]


def test_taxed_items_are_split(spark):
    items, bonuses = frames(
        spark, [("S", 1, "Invoice Disc.", True, "90", "10")], [("P", "8"), ("P", "2"), (None, "5")], "decimal(18,4)"
    )
    assert totals(rollups.bonus_rollup(items, bonuses)) == [(0, 0, 0, 0, 9, 1)]


def test_every_pair_on_a_line_counts(spark):
    items, bonuses = frames(
        spark,
        [("S", 1, "Invoice Disc.", True, "75", "25"), ("S", 1, "Invoice Disc.", False, "1", "1"),
         ("S", 1, "Invoice Disc. Item", True, "50", "50")],
        [("P", "8"), ("P", "4")],
    )
    assert totals(rollups.bonus_rollup(items, bonuses)) == [(6, 6, 0, 0, 21, 15)]


def test_unknown_bonus(spark):
    """Alone it gives NULL where it would have counted and 0 where it would not."""
    items, bonuses = frames(spark, [("S", 1, "Invoice Disc. Item", False, "1", "1")], [("P", None)])
    assert totals(rollups.bonus_rollup(items, bonuses)) == [(None, 0, 0, 0, 0, 0)]


def test_orders_restrict_and_weigh(spark):
    items, bonuses = frames(spark, [("S", 1, "Invoice Disc.", False, "1", "1")], [("P", "8")])
    twice = spark.createDataFrame([("S",), ("S",), ("T",)], "szFSoId string")
    assert totals(rollups.bonus_rollup(items, bonuses, twice)) == [(0, 0, 0, 0, 16, 16)]
    assert totals(rollups.bonus_rollup(items, bonuses, twice.where("szFSoId = 'T'"))) == []


def test_quantities_are_summed(spark):
    items = spark.createDataFrame(
        [("S", "W", "P", 1.0), ("S", "W", "P", 2.0), ("S", "W", "Q", 5.0)],
        "custOrderNo string, orderNo string, code string, qty double",
    )
    out = rollups.delivered_quantity(items).select("code", "qty")
    assert rows(out) == [("P", 3.0), ("Q", 5.0)]
    items = spark.createDataFrame(
        [("I", "P", 1.0), ("I", "P", 2.0)], "szFInvoiceId string, szProductId string, decQty double"
    )
    assert rows(rollups.invoiced_quantity(items)) == [("I", "P", 3.0)]


# Skewed joins.


@pytest.fixture
def skewed(spark, request):
    """A third of either side has key `hot`, some keys are blank, NULL, or on one side only."""
    rng = random.Random(5)

    def keys(count):
        return [rng.choice(["hot", "hot", "", " ", None, *"abcdefg"[: rng.randrange(1, 8)]]) for _ in range(count)]

    left = spark.createDataFrame([(k, i % 3, i) for i, k in enumerate(keys(160))], "lk string, lc int, lv int")
    right = spark.createDataFrame([(k, i % 2, i) for i, k in enumerate(keys(90))], "rk string, rc int, rv int")
    return left, right.where("rk <> 'e' or rk is null")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("on", [[("lk", "rk")], [("lk", "rk"), ("lc", "rc")]])
@pytest.mark.parametrize("sides", ["left", "right", "both", "blank", "all"])
def test_skew_join_is_the_plain_join(spark, skewed, how, on, sides):
    left, right = skewed
    heavy = [["hot", "e", "nowhere"], ["hot\u00010", "hot\u00011", "e\u00011"]][len(on) - 1]
    options = {
        "left": {"heavy_left": heavy},
        "right": {"heavy_right": heavy},
        "both": {"heavy_left": heavy, "heavy_right": heavy},
        "blank": {"spread_blank": True},
        "all": {"heavy_left": heavy, "heavy_right": heavy, "spread_blank": True},
    }[sides]
    only_if = "lv % 4 <> 1"
    condition = F.expr(" and ".join(f"{l} = {r}" for l, r in on))
    for extra in (None, only_if):
        expected = left.join(right, condition if extra is None else condition & F.expr(extra), how)
        out = skew_join(left, right, on, how, only_if=extra, salts=7, **options)
        assert rows(out.select(expected.columns)) == rows(expected)


def test_heavy_key_is_spread(spark):
    """No partition of the join holds much more than its share, on either side."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    many = spark.range(30_000).select(hot.alias("mk"), F.col("id").alias("mv"))
    one = spark.createDataFrame([("hot", 1), ("7", 2)], "ok string, ov int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        heavy = ("hot",)
        on_left = skew_join(many, one, [("mk", "ok")], "left", heavy_left=heavy, salts=64)
        on_right = skew_join(one, many, [("ok", "mk")], "left", heavy_right=heavy, salts=64)
        assert on_left.count() == 30_000 and on_right.count() == 10_001
        for joined, share in ((on_left, 0.2), (on_right, 0.2)):
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            assert max(r["count"] for r in sizes) < share * sum(r["count"] for r in sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_decimal_rollup_agrees_with_the_pairs(spark):
    """Summed shares against one rounded product per pair: equal to the fifth digit."""
    rng = random.Random(11)

    def money():
        return Decimal(rng.randrange(0, 10_000_000)).scaleb(-4)

    references = [d.reference for d in rollups.DISCOUNTS] + ["Other"]
    items = [
        (f"S{rng.randrange(40)}", rng.randrange(3), rng.choice(references), rng.random() < 0.7, money(), money())
        for _ in range(150)
    ]
    bonuses = [
        (f"S{rng.randrange(40)}", rng.randrange(3), f"P{rng.randrange(3)}", "R", "O", "JUAL", money())
        for _ in range(150)
    ]
    items = spark.createDataFrame(items, ITEM.format(m="decimal(18,4)"))
    bonuses = spark.createDataFrame(bonuses, BONUS.format(m="decimal(18,4)"))
    taxed = "case when bTaxable and decDPP + decTax <> 0 then decBonusAmount * {p} / (decDPP + decTax) else {e} end"
    sums = [
        f"sum(case when szPrincipalDiscRefId = '{d.reference}' then {taxed.format(p=p, e=e)} else 0 end) as {name}"
        for d in rollups.DISCOUNTS
        for name, p, e in (
            (d.net_name, "decDPP", "decBonusAmount"),
            (d.tax_name, "decTax", "decBonusAmount" if d.untaxed_tax_share else "0"),
        )
    ]
    pairs = items.join(bonuses, ["szFSoId", "shItemNumber"]).groupBy(*rollups.BONUS_KEYS)
    expected = {tuple(r)[:5]: tuple(r)[5:] for r in pairs.agg(*[F.expr(s) for s in sums]).collect()}
    names = [*rollups.BONUS_KEYS, *rollups.DISCOUNT_NAMES]
    actual = {tuple(r)[:5]: tuple(r)[5:] for r in rollups.bonus_rollup(items, bonuses).select(names).collect()}
    assert actual.keys() == expected.keys() and len(actual) > 50
    for key, row in actual.items():
        for x, y in zip(row, expected[key]):
            assert abs(x - y) <= Decimal("0.00002"), (key, x, y)


def test_missing_keys_are_spread(spark):
    """Rows that an earlier join gave no key, and rows of a blank id, beside a right side that is dealt by the key alone."""
    from orderweave.plans.chain import SALT_COLUMNS

    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).selectExpr("id as so_id", "if(id % 8 = 0, concat('k', id % 16), null) as k", "if(id % 8 = 0, concat('k', id % 16), '') as b", "'p' as p")
        right = spark.createDataFrame([("k0", "p", 1), ("k8", "p", 2), ("k8", "q", 3)], "r string, rp string, v int")
        dealt = right.join(right.select(F.col("r").alias("x")).distinct(), F.col("r") == F.col("x"), "left_semi")
        for key, options in (("k", {"spread_nulls": True}), ("b", {"spread_keys": ("",), "salts": 64}), ("b", {"spread_blank": True})):
            made = skew_join(left, dealt, [(key, "r"), ("p", "rp")], salt_by=SALT_COLUMNS, **options)
            plain = left.join(right, (F.col(key) == F.col("r")) & (F.col("p") == F.col("rp")), "left")
            assert rows(made.select(plain.columns)) == rows(plain)
            most = made.groupBy(F.spark_partition_id().alias("part")).count().agg(F.max("count")).first()[0]
            assert most < 2500, (key, options)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
