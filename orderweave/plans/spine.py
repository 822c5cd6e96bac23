"""Document headers in a date window: inquiry, sales order and purchase order.

An inquiry is dated by its purchase order, or by its sales order where it names
no purchase order.  Each kind is joined to the one table that dates it, filtered
by date, so old documents leave the plan at the first join.

Inquiries without a sales order (blank id) are planned apart from the rest:
they take their items from the purchase order, and their shared blank id is
joined with salts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import is_blank, is_empty, not_empty
from ..functions.windows import DateWindow
from ..operators import rollups
from .chain import SIDES, Chain

# Item types that count as sold and as bought.
SOLD = "JUAL"
BOUGHT = ("BELI", "BELI-BERIKAT")


#: Ids of the headers that many of them may share.
SHARED_IDS = ("si_so", "si_po", "si_do", "si_dn", "si_customer", "so_approval", "po_id")


def headers(
    chain: Chain,
    window: DateWindow,
    admitted: Column | None = None,
    *,
    with_sales_order: bool,
    order_join: str,
) -> DataFrame:
    """Inquiries in the window with their order and purchase order; `admitted` restricts the orders.

    With stages the headers of their whole window are stored, with all columns and
    whatever their orders are, and the dataset takes its own from them.
    """
    if chain.stages is None:
        orders = chain.orders() if admitted is None else chain.orders().where(admitted)
        return dated_inquiries(chain, window, orders, with_sales_order=with_sales_order, order_join=order_join)
    stored_window = chain.stages.window or window
    df = stored_headers(chain, stored_window, with_sales_order)
    if chain.stages.window is not None and chain.stages.run_orders is None and not is_wide(chain, stored_window):
        cut_sides(chain, stored_window)
    elif chain.stages.window is not None and chain.stages.run_orders is None:
        ids = [stored_headers(chain, stored_window, linked).select("si_so") for linked in (True, False)]
        ordered = chain.in_window(Chain(chain.tables).orders(), stored_window, "so_ordered", "so_month").select("so_id")
        chain.stages.run_orders = ids[0].unionByName(ids[1]).union(ordered).where("si_so is not null").distinct()
    if stored_window != window:
        dated = F.when(not_empty(F.col("si_po")), F.col("po_date")).otherwise(F.col("so_ordered"))
        df = df.where(window.contains(dated))
    if order_join == "inner":
        df = df.where("so_id is not null")
    df = df if admitted is None else df.where(admitted)
    return chain.stages.mark_wide(df) if with_sales_order and is_wide(chain, window) else df


def cut_sides(chain: Chain, window: DateWindow) -> None:
    """Store the ids that the headers of a run name, and what the side tables have of them.

    So each side table is read once for all datasets, and what the ids do not need of it is not shuffled.
    """
    stages, whole = chain.stages, Chain(chain.tables, chain.salts, stages=chain.stages)
    linked, unlinked = (stored_headers(chain, window, kind) for kind in (True, False))
    dated = whole.stored("run-dated", lambda: chain.in_window(Chain(chain.tables).orders(), window, "so_ordered", "so_month").select("so_id", "so_do", "so_approval"))
    kinds = {
        "order": (linked.select("si_so"), unlinked.select("si_so"), dated.select("so_id")),
        "approval": (linked.select("so_approval"), unlinked.select("so_approval"), dated.select("so_approval")),
        "delivery": (linked.select("si_do"), unlinked.select("si_do"), dated.select("so_do")),
        "note": (linked.select("si_dn"), unlinked.select("si_dn")),
        "purchase": (unlinked.select("po_id"),),
    }

    def ids(frames: tuple[DataFrame, ...]) -> DataFrame:
        return reduce(DataFrame.union, frames).toDF("run_id").where("run_id is not null").distinct()

    def stored(kind: str, frames: tuple[DataFrame, ...]) -> DataFrame:
        return whole.stored(f"run-ids-{kind}", lambda: ids(frames))

    found = stages.together(*[lambda item=item: stored(*item) for item in kinds.items()])
    stages.run_ids = dict(zip(kinds, found, strict=True))
    stages.run_orders = stages.run_ids["order"]
    with stages.bloom_filters():
        stages.together(*[lambda name=name: whole.side(name) for name, (_, kind) in SIDES.items() if kind in kinds])
        stages.run_ids["invoice"] = stored("invoice", (whole.side("deliveries").select("do_invoice"),))
        stages.together(*[lambda name=name: whole.side(name) for name, (_, kind) in SIDES.items() if kind == "invoice"], lambda: whole.note_status())


def is_wide(chain: Chain, window: DateWindow) -> bool:
    """With stages: does the window hold nine tenths of the purchase orders or more, which date most inquiries?"""
    return chain.stages is not None and chain.stages.is_wide(window, chain.purchase_orders(), "po_date")


def both_headers(chain: Chain, window: DateWindow) -> DataFrame:
    """The stored headers with and without a sales order as one frame; `linked` tells them apart."""
    stored_window = chain.stages.window or window
    chain.stages.together(*[lambda kind=kind: stored_headers(chain, stored_window, kind) for kind in (True, False)])
    linked, unlinked = (
        headers(chain, window, with_sales_order=kind, order_join="left").withColumn("linked", F.lit(kind)) for kind in (True, False)
    )
    both = linked.unionByName(unlinked, allowMissingColumns=True)
    return chain.stages.mark_wide(both) if is_wide(chain, window) else both


def stored_headers(chain: Chain, window: DateWindow, with_sales_order: bool) -> DataFrame:
    """The headers of a window, stored once, with the ids that many of them share watched."""
    whole = Chain(chain.tables, chain.salts, stages=chain.stages)

    def build() -> DataFrame:
        return dated_inquiries(whole, window, whole.orders(), with_sales_order=with_sales_order, order_join="left")

    name = chain.stages.name("linked" if with_sales_order else "unlinked", window)
    with chain.stages.bloom_filters():
        df = chain.stored(name, build)
    chain.stages.watch(name, df, SHARED_IDS)
    return df


def dated_inquiries(
    chain: Chain,
    window: DateWindow,
    orders: DataFrame,
    *,
    with_sales_order: bool,
    order_join: str,
) -> DataFrame:
    """Inquiries in the window with their order, purchase order and receipts.

    Those with a sales order also learn whether their purchase order has a
    bought item (`has_bought`).
    """
    blank = is_blank(F.col("si_so"))
    inquiries = chain.inquiries().where(~blank if with_sales_order else blank)
    if not with_sales_order:
        orders = chain.blank_only(orders, "so_id")
    spread = not with_sales_order
    by_order = [("si_so", "so_id")]
    by_purchase = [("si_po", "po_id")]
    by_flag = [("po_id", "poi_po")]
    purchases = chain.purchase_orders()
    receipts = chain.receipts().where(not_empty(F.col("receipt_po")))
    in_window = chain.in_window(purchases, window, "po_date", "po_month")
    # With stages, the inquiries of a narrow window are found first; they cut what is joined to them.
    first = chain.stages is not None and not is_wide(chain, window)
    name = "" if chain.stages is None else chain.stages.name("linked" if with_sales_order else "unlinked", window)

    items, named_orders = chain.purchase_items(), orders
    bought = chain.join(inquiries.where(not_empty(F.col("si_po"))), in_window, by_purchase, "inner")
    if first:
        found = bought = chain.stored(f"bought-{name}", lambda plan=bought: plan)
        receipts = chain.among(receipts, "receipt_po", found, "po_id")
        if with_sales_order:
            items = chain.among(items, "poi_po", found, "po_id")
            named_orders = chain.among(orders, "so_id", found, "si_so")
    if with_sales_order:
        bought = chain.join(bought, bought_flags(chain, items), by_flag)
    bought = chain.join(bought, receipts, [("po_id", "receipt_po")])
    bought = chain.join(bought, named_orders, by_order, order_join, spread=spread)

    sold = chain.join(
        inquiries.where(is_empty(F.col("si_po"))),
        chain.in_window(orders, window, "so_ordered", "so_month"),
        by_order,
        "inner",
        spread=spread,
    )
    if first:
        sold = chain.stored(f"sold-{name}", lambda plan=sold: plan)
    # A purchase order with a blank id matches here; its receipts do not.
    unnamed = chain.blank_only(purchases, "po_id")
    sold = chain.join(sold, unnamed, by_purchase, spread=True)
    if with_sales_order:
        flags = chain.blank_only(bought_flags(chain), "poi_po")
        sold = chain.join(sold, flags, by_flag, spread=True)
    return bought.unionByName(sold, allowMissingColumns=True)


def order_ids_in_window(chain: Chain, window: DateWindow, scope: DataFrame) -> DataFrame:
    """Sales-order ids of the inquiries in the window, from their stored headers (`scope`) if there are any."""
    if chain.stages is not None:
        return scope.select(F.col("si_so").alias("scope_so"))
    inquiries = chain.pick("sales_inquiry", si_so="szFSoId", si_po="szFPoId")
    inquiries = inquiries.where(~is_blank(F.col("si_so")))
    bought = chain.join(
        inquiries.where(not_empty(F.col("si_po"))),
        chain.in_window(chain.purchase_orders(), window, "po_date", "po_month"),
        [("si_po", "po_id")],
        "left_semi",
    )
    sold = chain.join(
        inquiries.where(is_empty(F.col("si_po"))),
        chain.in_window(chain.orders(), window, "so_ordered", "so_month"),
        [("si_so", "so_id")],
        "left_semi",
    )
    ids = bought.select("si_so").unionByName(sold.select("si_so"))
    return ids.withColumnRenamed("si_so", "scope_so")


def bought_flags(chain: Chain, items: DataFrame | None = None) -> DataFrame:
    """Purchase orders with at least one bought item, of all items or of some."""
    flags = rollups.purchase_flags(chain.purchase_items() if items is None else items, "poi_po", "poi_type", BOUGHT)
    return flags.withColumn("has_bought", F.lit(True))


def is_sold() -> Column:
    return F.col("soi_type") == SOLD


def is_bought() -> Column:
    return F.col("poi_type").isin(*BOUGHT)


def with_sales_items(chain: Chain, df: DataFrame, scope: DataFrame | None, items: DataFrame | None = None) -> DataFrame:
    """Items of the matched sales order: sold ones, or all if the purchase order has a bought one.

    `scope`, if given, holds the ids of all orders that can match; `items` may be the order items with more columns, or fewer.
    """
    items = chain.order_items(scope) if items is None else items
    df = chain.join(df, items, [("si_so", "soi_so")], only_if="so_id is not null")
    return df.where(is_sold() | F.col("has_bought"))


def sales_lines(chain: Chain, documents: DataFrame, scope: DataFrame | None, *ids: str) -> DataFrame:
    """The products of the sales items of stored documents, with nothing but the order's id and some more ids of the document."""
    narrow = documents.select("si_so", "so_id", "has_bought", *ids).distinct()
    items = chain.order_items(scope).select("soi_so", "soi_product", "soi_type")
    return with_sales_items(chain, narrow, scope, items).select("si_so", *ids, "soi_product", "soi_type").where("soi_product is not null").distinct()


def by_order(chain: Chain, df: DataFrame, lines: DataFrame, side: DataFrame, on: list[tuple[str, str]], name: str) -> DataFrame:
    """The left join of a side table to item rows that are dealt by order, without moving them.

    The narrow `lines` of the same rows meet the side table, and what they find, stored, comes back by order.
    """
    keys = ["si_so", *[left for left, _ in on]]

    def build() -> DataFrame:
        wanted = lines.select(*keys).where(F.col(on[0][0]).isNotNull()).distinct()
        found = chain.join(wanted, side, on, "inner", spread=True)
        values = [c for c in side.columns if c not in dict(on).values()]
        return found.select(*[F.col(k).alias(f"{on[0][1]}_{k}") for k in keys], *values)

    return chain.join(df, chain.stored(name, build), [(k, f"{on[0][1]}_{k}") for k in keys])


def with_purchase_items(chain: Chain, df: DataFrame, scope: DataFrame) -> DataFrame:
    """Items for inquiries without a sales order; `scope` are their headers.

    Where an order with a blank id is stored, its items belong to all of them.
    """
    items = chain.side("purchase_items", scope, "po_id")
    by_purchase = [("po_id", "poi_po")]
    sales_items = chain.blank_only(chain.order_items(), "soi_so")
    df = chain.join(
        df, sales_items, [("si_so", "soi_so")], only_if="so_id is not null", spread=True
    )
    df = chain.join(df, items, by_purchase, spread=True)
    return df.where(is_sold() | is_bought())


def with_products(chain: Chain, df: DataFrame, key: str) -> DataFrame:
    return chain.join(df, chain.products(), [(key, "product_id")], spread=True)


def absent(df: DataFrame, **types: str) -> DataFrame:
    """Columns that no document can fill, as NULLs of their type."""
    return df.selectExpr("*", *[f"cast(null as {t}) as {name}" for name, t in types.items()])
