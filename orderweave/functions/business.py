"""Business expressions of the order-tracking datasets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import flag_or_false, is_blank, is_empty, number_or_zero, trimmed


def order_number(customer_po: Column, inquiry_po: Column) -> Column:
    """The customer's own PO number, or the inquiry's where it is blank."""
    return F.when(is_blank(customer_po), inquiry_po).otherwise(F.trim(customer_po))


def by_sales_order(so_id: Column, from_purchase: Column, from_sales: Column) -> Column:
    """Purchase-side value for an inquiry without a sales order, else the sales side."""
    return F.when(is_blank(so_id), from_purchase).otherwise(from_sales)


def by_purchase_order(po_id: Column, without_po: Column, with_po: Column) -> Column:
    """Value by whether the PO id is empty; a NULL id counts as present."""
    return F.when(is_empty(po_id), without_po).otherwise(with_po)


def _has_tax_base(taxable: Column, net: Column, tax: Column) -> Column:
    return taxable & ((net + tax) != 0)


def tax_share(
    amount: Column, taxable: Column, net: Column, tax: Column, part: Column, otherwise: Column
) -> Column:
    """`amount` times `part` of the tax base, or `otherwise` where nothing is taxed.

    The product comes before the quotient, so decimals lose no digits early.
    """
    return F.when(_has_tax_base(taxable, net, tax), amount * part / (net + tax)).otherwise(otherwise)


def discount_net(discount: Column, taxable: Column, net: Column, tax: Column) -> Column:
    return tax_share(discount, taxable, net, tax, net, discount)


def discount_tax(discount: Column, taxable: Column, net: Column, tax: Column) -> Column:
    return tax_share(discount, taxable, net, tax, tax, F.lit(0))


def net_price(price: Column, taxable: Column, net: Column, tax: Column) -> Column:
    return tax_share(price, taxable, net, tax, net, price)


def net_amount(amount: Column, *discounts: Column) -> Column:
    for discount in discounts:
        amount = amount - number_or_zero(discount)
    return amount


def quantity_if_present(document_id: Column, quantity: Column) -> Column:
    """Zero unless the document exists."""
    return F.when(is_blank(document_id), F.lit(0)).otherwise(number_or_zero(quantity))


def quantity_or_units(quantity: Column, units: Column) -> Column:
    """Quantity, or the unit quantity where it is zero; NULL stays NULL."""
    return F.when(quantity == 0, units).otherwise(quantity)


def replaced(replacement_id: Column, original: Column, replacement: Column) -> Column:
    """`replacement` where a replacing document exists, else `original`."""
    return F.when(F.coalesce(F.rtrim(replacement_id), F.lit("")) == "", original).otherwise(replacement)


def _next_level(max_level: Column) -> Column:
    return (F.coalesce(max_level.cast("int"), F.lit(0)) + 1).cast("string")


def approval_level(applied: Column, void: Column, max_level: Column) -> Column:
    """Level an order waits for; empty once it is applied or void."""
    return F.when(applied | void, F.lit("")).otherwise(_next_level(max_level))


def approval_level_unlinked(applied: Column, void: Column, max_level: Column) -> Column:
    """As `approval_level`, but an order known to be neither waits for level 1."""
    return (
        F.when(applied | void, F.lit(""))
        .when(~applied & ~void, F.lit("1"))
        .otherwise(_next_level(max_level))
    )


def joined_key(*parts: Column, separator: str = "-") -> Column:
    """Concatenate, a NULL part counting as empty text."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part, F.lit("")))
    return F.concat(*pieces)


def contains_none(c: Column, fragments: list[str] | tuple[str, ...]) -> Column:
    """No fragment occurs in the text; NULL for NULL, so a filter drops the row."""
    keep = F.lit(True)
    for fragment in fragments:
        keep = keep & ~c.contains(fragment)
    return keep


__all__ = [
    "approval_level",
    "approval_level_unlinked",
    "by_purchase_order",
    "by_sales_order",
    "contains_none",
    "discount_net",
    "discount_tax",
    "flag_or_false",
    "joined_key",
    "net_amount",
    "net_price",
    "order_number",
    "quantity_if_present",
    "quantity_or_units",
    "replaced",
    "tax_share",
    "trimmed",
]
