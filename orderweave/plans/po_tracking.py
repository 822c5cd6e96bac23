"""Purchase-order tracking: one calendar month, and three months by delivery month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import business as b
from ..functions.nulls import date_or_default, flag_or_false, is_blank, number_or_zero, text_or_default
from ..functions.windows import DateFloor, DateWindow
from ..operators.joins import flag_states, surviving_flags
from ..sources import Tables
from .chain import Chain
from .stages import Stages
from .spine import (
    absent,
    by_order,
    headers,
    sales_lines,
    stored_headers,
    with_products,
    with_purchase_items,
    with_sales_items,
)

# Channels kept, and marks of reservation orders.
CHANNELS = ("GT", "MTI")
RESERVED = ("RES0", "RES1", "RES2")

# Columns of the shared frames that neither dataset needs.
UNUSED = frozenset(
    "si_status si_carrier si_vehicle si_driver si_eta si_sent_wms"
    " so_customer so_payment_term so_type so_do so_applied so_void"
    " soi_units soi_net soi_tax soi_price soi_taxable po_status po_void"
    " poi_tax poi_net poi_discount poi_price poi_taxable receipt_id receipt_created".split()
)

# What is left to do on the headers of the quarter dataset needs of them.
KEPT = tuple(
    "si_so si_po si_dn si_customer so_id so_customer_po so_created so_ordered po_created has_bought receipt_date delv_no delv_out"
    " cust_name category_name dn_id dn_updated cl_applied rejected canceled transfer_time".split()
)


def _in_channels(chain: Chain, channels: tuple[str, ...]) -> DataFrame:
    return chain.customers().where(F.col("category_name").isin(*channels))


def not_rejected(chain: Chain, df: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Rows whose approval is not rejected; an approval with both flags keeps the other one's row."""
    approvals = chain.side("rejections", scope, "so_approval")
    states = flag_states(approvals, "rejected_id", "rejected")
    return surviving_flags(
        chain.join(df, states, [("so_approval", "_flag_key")], spread=True), "rejected"
    )


def not_canceled(chain: Chain, df: DataFrame, spread: bool, scope: DataFrame | None = None) -> DataFrame:
    """Rows whose order is not canceled, with the same rule; `spread` for rows without an order id."""
    log = chain.side("cancels", scope, "si_so")
    if spread:
        log = chain.blank_only(log, "cancel_so")
    states = flag_states(log, "cancel_so", "canceled")
    return surviving_flags(
        chain.join(df, states, [("si_so", "_flag_key")], spread=spread), "canceled"
    )


def _shared_columns(with_sales_order: bool) -> dict[str, Column]:
    """Columns both datasets have, in their order."""
    c = F.col
    side = "soi" if with_sales_order else "poi"
    amount = c(f"{side}_amount")
    return {
        "purchase_order_number": b.order_number(c("so_customer_po"), c("si_po")),
        "date_created": date_or_default(c("po_created")),
        "po_on_review_date": date_or_default(c("so_created")),
        "po_approve_lv1_date": date_or_default(c("so_ordered")),
        "sales_order_number": c("si_so"),
        "canceled_order": c("canceled"),
        "rejected_order": c("rejected"),
        "send_to_wms_date": date_or_default(c("transfer_time")),
        "customer_id": c("si_customer"),
        "customer_name": c("cust_name"),
        "customer_category_description": text_or_default(c("category_name")),
        "delivered_date_feedback_wms": date_or_default(c("delv_out")),
        "received_date": date_or_default(c("receipt_date")),
        "poDate": b.by_purchase_order(c("si_po"), c("so_created"), c("po_created")),
        "product_id": c(f"{side}_product"),
        "product_name": c("product_name"),
        "qty_order": c(f"{side}_qty"),
        "amount_incl_ppn_before_discount": amount,
        "nett_amount_incl_ppn": b.net_amount(
            amount, c("decDiscFakturDPP"), c("decDiscFakturTax")
        ),
        "bStatusDN": flag_or_false(c("cl_applied")),
        "dn_closed_date": date_or_default(c("dn_updated")),
        "szfdnid": c("si_dn"),
    }


def _with_notes(chain: Chain, df: DataFrame, scope: DataFrame) -> DataFrame:
    notes = chain.side("delivery_notes", scope, "si_dn")
    df = chain.join(df, notes, [("si_dn", "dn_id")], spread=True)
    return chain.join(df, chain.note_status(scope), [("si_dn", "closed_dn")], spread=True)


def po_tracking_month(
    tables: Tables,
    window: DateWindow,
    *,
    created: DateWindow | None = None,
    bonus_floor: DateFloor | None = None,
    channels: tuple[str, ...] = CHANNELS,
    reserved: tuple[str, ...] = RESERVED,
    salts: int | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Items ordered in `window`, whose sales order was also created in `created`.

    `created` and `bonus_floor` default to the window and its start.
    """
    chain = Chain(tables, salts, UNUSED, stages)
    created = created or window
    bonus_floor = bonus_floor or DateFloor(window.start)
    admitted = created.contains(F.col("so_created")) & b.contains_none(F.col("so_customer_po"), reserved)
    if stages is not None:
        stages.together(*[lambda kind=kind: stored_headers(chain, stages.window or window, kind) for kind in (True, False)])
    linked, unlinked = (
        headers(chain, window, admitted, with_sales_order=with_sales_order, order_join="inner")
        for with_sales_order in (True, False)
    )
    rows = _month_rows(chain, linked, admitted, bonus_floor, channels, True)
    # A row needs its sales order: inquiries without one count where an order has a blank id.
    if stages is not None and stages.is_empty(f"unlinked with orders {window} {created} {reserved}", unlinked):
        return rows
    return rows.unionByName(_month_rows(chain, unlinked, admitted, bonus_floor, channels, False))


def _month_rows(
    chain: Chain,
    scope: DataFrame,
    admitted: Column,
    bonus_floor: DateFloor,
    channels: tuple[str, ...],
    with_sales_order: bool,
) -> DataFrame:
    """The dataset's rows of the headers in `scope`."""
    spread = not with_sales_order
    df = chain.join(scope, _in_channels(chain, channels), [("si_customer", "cust_id")], "inner", spread=True)
    df = not_rejected(chain, df, scope)
    df = _with_notes(chain, df, scope)
    deliveries = chain.side("deliveries", scope, "si_do").select("do_id")
    df = chain.join(df, deliveries, [("si_do", "do_id")], spread=True)

    # From here on every join is by sales order.
    df = not_canceled(chain, df, spread, scope)
    transfers = chain.side("transfers", scope, "si_so")
    if spread:
        transfers = chain.blank_only(transfers, "transfer_so").distinct()
    df = chain.join(df, transfers, [("si_so", "transfer_so")], spread=spread)
    if chain.stages is None:
        orders = chain.orders().where(admitted).select(F.col("so_id").alias("scope_so"))
    else:
        orders = scope.select(F.col("si_so").alias("scope_so")).distinct() if chain.stages.cuts(scope) else None
    if with_sales_order:
        confirmations = chain.side("confirmations", scope, "si_so")
        df = chain.join(df, confirmations, [("si_so", "delv_so"), ("do_id", "delv_do")])
        df = with_sales_items(chain, df, orders)
    else:
        df = absent(df, delv_out="timestamp_ntz")
        df = with_purchase_items(chain, df, scope)
    discounted = chain.orders_since(bonus_floor, orders)
    df = chain.join_bonuses(df, chain.bonuses(discounted), "si_so")
    df = with_products(chain, df, "soi_product" if with_sales_order else "poi_product")
    columns = _shared_columns(with_sales_order)
    return df.select([value.alias(name) for name, value in columns.items()]).distinct()


def _on_kept(chain: Chain, kept: DataFrame, name: str, window: DateWindow) -> Chain:
    """A chain for what is left to do on stored headers: their orders and notes, few or many, cut the side tables before these are shuffled."""

    def ids(column: str) -> DataFrame:
        return kept.select(F.col(column).alias("run_id")).where("run_id is not null").distinct()

    stages = chain.stages
    kinds = {kind: chain.stored(f"ids-{kind}-{name}", lambda column=column: ids(column)) for kind, column in (("order", "si_so"), ("note", "si_dn"))}
    within = Chain(chain.tables, chain.salts, chain.unused, stages.within(name, window, kinds))
    with stages.bloom_filters():
        sides = ("orders", "order_lines", "bonus_source", "delivered_items", "delivery_note_items")
        stages.together(*[lambda side=side: within.side(side) for side in sides])
    return within


def po_tracking_by_delivery(
    tables: Tables,
    window: DateWindow,
    delivered: DateWindow,
    *,
    bonus_floor: DateFloor | None = None,
    channels: tuple[str, ...] = CHANNELS,
    salts: int | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Items ordered in `window` and delivered in `delivered`.

    `bonus_floor` defaults to the start of the delivery window: orders placed
    before it carry no invoice discount.
    """
    chain = Chain(tables, salts, UNUSED | {"soi_qty"}, stages)
    bonus_floor = bonus_floor or DateFloor(delivered.start)
    # Every row needs a delivery confirmation, which names a sales order.
    dated = headers(chain, window, with_sales_order=True, order_join="left")
    confirmations = chain.side("confirmations", dated, "si_so").where(delivered.contains(F.col("delv_out")))
    df = chain.join(dated, confirmations, [("si_so", "delv_so"), ("si_do", "delv_do")], "inner")
    df = chain.join(df, _in_channels(chain, channels), [("si_customer", "cust_id")], "inner", spread=True)
    deliveries = chain.side("deliveries", dated, "si_do").select("do_id")
    df = chain.join(df, deliveries, [("si_do", "do_id")], "left_semi", spread=True)
    df = not_rejected(chain, df, dated)
    df = _with_notes(chain, df, dated)

    df = not_canceled(chain, df, False, dated)
    transfers = chain.side("transfers", dated, "si_so")
    df = chain.join(df, transfers, [("si_so", "transfer_so")])
    if stages is not None and stages.run_ids is None and not stages.cuts(dated):
        name = stages.name(f"quarter {delivered.start} {delivered.end} {'closed' if delivered.closed else 'open'} {' '.join(channels)}", window)
        kept = df = chain.stored(name, lambda plan=df.select(*KEPT): plan)
        chain = _on_kept(chain, kept, name, window)
    else:
        kept = None
    scope = confirmations.select(F.col("delv_so").alias("scope_so")) if kept is None else kept.select(F.col("si_so").alias("scope_so"))
    items = chain.order_items(scope)
    if kept is not None:  # from here on every join is by sales order
        items = with_products(chain, items, "soi_product")
    df = with_sales_items(chain, df, scope, items)
    df = chain.join(
        df,
        chain.delivered(scope),
        [("si_so", "dlv_so"), ("delv_no", "dlv_no"), ("soi_product", "dlv_product")],
    )
    discounted = chain.orders_since(bonus_floor, scope)
    df = chain.join_bonuses(df, chain.bonuses(discounted), "si_so")
    # By the inquiry's note id: where the note is missing the quantity is zero anyway.
    by_note = [("si_dn", "dni_dn"), ("soi_product", "dni_product")]
    note_items = chain.side("delivery_note_items", dated, "si_dn")
    if kept is None:
        df = chain.join(df, note_items, by_note, spread=True)
        df = with_products(chain, df, "soi_product")
    else:
        noted = kept.withColumn("si_dn", F.when(~is_blank(F.col("dn_id")), F.col("si_dn")))
        df = by_order(chain, df, sales_lines(chain, noted, scope, "si_dn"), note_items, by_note, "noted")

    columns = _shared_columns(with_sales_order=True)
    del columns["qty_order"]
    names = list(columns)
    at = names.index("amount_incl_ppn_before_discount")
    columns["qty_delivered"] = number_or_zero(F.col("dlv_qty"))
    columns["close_dn_qty"] = b.quantity_if_present(F.col("dn_id"), F.col("dni_qty"))
    columns["InvoiceProductID"] = b.joined_key(
        columns["purchase_order_number"], columns["product_id"]
    )
    names[at:at] = ["qty_delivered", "close_dn_qty"]
    names.append("InvoiceProductID")
    return df.select([columns[name].alias(name) for name in names]).distinct()
