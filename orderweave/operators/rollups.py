"""Aggregations of item tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import skew_join


@dataclass(frozen=True)
class Discount:
    """One discount reference and what an untaxed item adds to its tax share."""

    reference: str
    net_name: str
    tax_name: str
    untaxed_tax_share: int


# Discount references, output columns, and the untaxed tax share.
# The first reference adds nothing, the others add the full bonus a second time.
DISCOUNTS = (
    Discount("Invoice Disc. Item", "decDisc1DPP", "decDisc1Tax", 0),
    Discount("Invoice Disc. Item 2", "decDisc2DPP", "decDisc2Tax", 1),
    Discount("Invoice Disc.", "decDiscFakturDPP", "decDiscFakturTax", 1),
)

DISCOUNT_NAMES = tuple(n for d in DISCOUNTS for n in (d.net_name, d.tax_name))
BONUS_KEYS = ("szFSoId", "szProductId", "szParentId", "szPaymentType", "szOrderItemTypeId")


def delivered_quantity(items: DataFrame) -> DataFrame:
    """Delivered quantity per order, delivery and product."""
    return items.groupBy("custOrderNo", "code", "orderNo").agg(F.sum("qty").alias("qty"))


def invoiced_quantity(items: DataFrame) -> DataFrame:
    """Invoiced quantity per invoice and product."""
    return items.groupBy("szFInvoiceId", "szProductId").agg(F.sum("decQty").alias("decQty"))


def purchase_flags(items: DataFrame, key: str, item_type: str, kinds: tuple[str, ...]) -> DataFrame:
    """Keys having at least one item of the given kinds."""
    return items.where(F.col(item_type).isin(*kinds)).select(key).distinct()


def _item_shares(items: DataFrame) -> DataFrame:
    """Per order line: how much of a bonus on that line goes into each output.

    `fixed` outputs say that some item adds 0 whatever the bonus is, which
    matters only for a bonus of unknown amount.
    """
    net, tax = F.col("decDPP"), F.col("decTax")
    taxed = F.coalesce(F.col("bTaxable") & ((net + tax) != 0), F.lit(False))
    aggregates: list[Column] = []
    for d in DISCOUNTS:
        applies = F.coalesce(F.col("szPrincipalDiscRefId") == d.reference, F.lit(False))
        net_share = F.when(taxed, net / (net + tax)).otherwise(1)
        tax_share = F.when(taxed, tax / (net + tax)).otherwise(d.untaxed_tax_share)
        tax_fixed = ~applies if d.untaxed_tax_share else ~applies | ~taxed
        aggregates += [
            F.sum(F.when(applies, net_share).otherwise(0)).alias(f"_{d.net_name}"),
            F.sum(F.when(applies, tax_share).otherwise(0)).alias(f"_{d.tax_name}"),
            F.bool_or(~applies).alias(f"_fixed_{d.net_name}"),
            F.bool_or(tax_fixed).alias(f"_fixed_{d.tax_name}"),
        ]
    if "_weight" in items.columns:
        aggregates.append(F.max("_weight").alias("_weight"))
    return items.groupBy(
        F.col("szFSoId").alias("_so"), F.col("shItemNumber").alias("_line")
    ).agg(*aggregates)


def bonus_rollup(
    items: DataFrame,
    bonuses: DataFrame,
    orders: DataFrame | None = None,
    *,
    salts: int = 64,
    heavy: Sequence[str | None] | None = None,
) -> DataFrame:
    """Discounts per order, product, parent, payment type and item type.

    Every bonus is split over the items of its order line.  The items' shares
    are summed per line first, so a line with many items and many bonuses never
    forms their pairs.  `orders` (one id column, `szFSoId`) restricts the
    roll-up; an order listed twice counts twice.  `heavy` are the order ids with
    too many rows for a task, if they are known: where there are none, both sides
    are dealt by order once, and neither the join nor the groups move them again.
    """
    by_order = heavy is not None and not heavy
    if by_order:
        items, bonuses = items.repartition("szFSoId"), bonuses.repartition("szFSoId")
    if orders is not None:
        weights = orders.groupBy(F.col("szFSoId").alias("_order")).agg(
            F.count(F.lit(1)).alias("_weight")
        )
        items = skew_join(
            items, weights, [("szFSoId", "_order")], "inner", spread_blank=heavy is None, spread_keys=heavy or (), salts=salts
        )
    bonuses = bonuses.where(F.col("szProductId").isNotNull())
    # By order and line: unless dealt by order, the lines of a blank order id do not meet in one task.
    lines = skew_join(
        bonuses, _item_shares(items), [("szFSoId", "_so"), ("shItemNumber", "_line")], "inner"
    )
    amount = F.col("decBonusAmount")
    weight = F.lit(1) if orders is None else F.max("_weight")

    def total(name: str) -> Column:
        part = F.when(amount.isNotNull(), amount * F.col(f"_{name}"))
        return (F.sum(part.when(F.col(f"_fixed_{name}"), 0)) * weight).alias(name)

    return lines.groupBy(*BONUS_KEYS).agg(*[total(name) for name in DISCOUNT_NAMES])
