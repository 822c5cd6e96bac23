"""Wide order tracking: orders with an inquiry, and orders without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import business as b
from ..functions.nulls import (
    date_or_default,
    date_or_parts,
    flag_or_false,
    is_blank,
    not_empty,
    number_or_zero,
    text_or_default,
    trimmed,
)
from ..functions.windows import DateFloor, DateWindow
from ..operators.joins import anti_join_null_aware
from ..operators.ranking import highest, join_top_row, top_per_key
from ..operators.rollups import DISCOUNT_NAMES
from ..sources import Tables
from .chain import Chain
from .spine import (
    absent,
    both_headers,
    by_order,
    headers,
    order_ids_in_window,
    sales_lines,
    with_products,
    with_purchase_items,
    with_sales_items,
)
from .stages import Stages

LEVELS = (1, 2, 3)

# Right sides' own keys, which nothing needs once the documents are looked up.
FOUND_KEYS = (
    "cust_id", "gd1_id", "gd2_id", "gd3_id", "gd_id", "closed_dn", "transfer_so", "cancel_so", "receipt_po", "old_do", "do_invoice"
)

# Columns of the shared frames that each dataset does not need.
UNUSED_BY_INQUIRY = frozenset(
    "so_customer so_type so_do soi_units do_carrier do_vehicle do_driver do_created".split()
)
UNUSED_BY_NO_INQUIRY = frozenset({"soi_amount"})


def _scoped_deliveries(chain: Chain, scope: DataFrame | None, key: str, name: str) -> DataFrame:
    """Delivery orders; with stages, those that the headers in `scope` name, stored once, the invoices they share watched."""
    if chain.stages is None:
        return chain.deliveries()
    if chain.stages.run_ids is not None:
        df = chain.side("deliveries")
        chain.stages.watch("run-deliveries", df, ("do_invoice",))
        return df
    whole = Chain(chain.tables, chain.salts, stages=chain.stages)
    df = chain.stored(f"deliveries-{name}", lambda: whole.side("deliveries", scope, key))
    chain.stages.watch(f"deliveries-{name}", df, ("do_invoice",))
    return df


def with_deliveries(chain: Chain, df: DataFrame, key: str, scope: DataFrame | None = None, name: str = "") -> DataFrame:
    """Delivery order and its invoice; `name` is that of the headers in `scope`."""
    deliveries = _scoped_deliveries(chain, scope, key, name)
    df = chain.join(df, deliveries, [(key, "do_id")], spread=True)
    invoices = chain.side("invoices", deliveries, "do_invoice")
    return chain.join(df, invoices, [("do_invoice", "invoice_id")], spread=True, spread_nulls=True)


def _scoped_approvals(chain: Chain, scope: DataFrame | None, name: str) -> DataFrame:
    """Approval items; with stages, those of the headers in `scope`, read and cut once for all levels."""

    if chain.stages is not None and chain.stages.run_ids is not None:
        return chain.side("approval_items")
    return chain.stored(f"approvals-{name}", lambda: chain.side("approval_items", scope, "so_approval"))


def with_approvals(chain: Chain, df: DataFrame, scope: DataFrame | None = None, name: str = "") -> DataFrame:
    """Approval levels 1 to 3 side by side, and the highest level of the order; `name` is that of the headers in `scope`."""

    items = _scoped_approvals(chain, scope, name)
    for n in LEVELS:
        level = items.where(F.col("gd_level") == n)
        level = level.selectExpr(f"gd_id as gd{n}_id", f"gd_time as gd{n}_time", f"gd_approved as gd{n}_approved")
        df = chain.join(df, level, [("so_approval", f"gd{n}_id")], spread=True)
    levels = highest(items.select("gd_id", "gd_level"), "gd_id", "gd_level", "max_level")
    return chain.join(df, levels, [("so_approval", "gd_id")], spread=True)


def _approval_columns() -> dict[str, Column]:
    columns: dict[str, Column] = {}
    for n in LEVELS:
        columns[f"dtmApproved{n}"] = date_or_default(F.col(f"gd{n}_time"))
        columns[f"bApproved{n}"] = F.col(f"gd{n}_approved")
    return columns


def replacement_invoices(chain: Chain, per_key: bool = False) -> DataFrame:
    """Invoices of deliveries that replaced another: `(old_do, new_invoice)`.

    By default only the latest entry of the whole history counts, as the
    datasets define it; `per_key` takes the latest entry of every old delivery.
    """
    history = chain.pick(
        "delivery_history", new_do="szDoId", old_do="szDoIdOld", changed="dtmLastUpdated"
    )
    latest = [F.desc_nulls_last("changed"), F.asc("old_do"), F.asc("new_do")]
    deliveries = chain.pick("delivery_order", newdo_id="szDoId", newdo_invoice="szFInvoiceId")
    invoices = chain.pick("invoice", new_invoice="szFInvoiceId")
    if per_key:
        history = top_per_key(history, ["old_do"], latest)
        found = chain.join(deliveries, history, [("newdo_id", "new_do")], "inner")
    else:
        found = join_top_row(deliveries, history, ("newdo_id", "new_do"), latest).where("new_do is not null")
    # Stored, so that Spark knows how few they are: else it shuffles all invoices and their items.
    df = chain.stored(f"replaced-{per_key}", lambda: found.select("old_do", "newdo_invoice").distinct())
    df = chain.join(df, invoices, [("newdo_invoice", "new_invoice")], "inner").select("old_do", "new_invoice")
    return chain.stored(f"replacements-{per_key}", lambda: df)


def replacement_sides(chain: Chain, per_key: bool = False) -> tuple[DataFrame, DataFrame]:
    """Replacement invoices and their items."""
    replacements = replacement_invoices(chain, per_key).distinct()
    items = chain.pick(
        "invoice_item", newitem_invoice="szFInvoiceId", newitem_product="szProductId", newitem_qty="decQty"
    )
    return replacements, chain.join(items, replacements, [("newitem_invoice", "new_invoice")], "left_semi")


def with_replacements(chain: Chain, df: DataFrame, replacements: DataFrame) -> DataFrame:
    """Replacement invoice of the row's delivery."""
    return chain.join(df, replacements, [("do_id", "old_do")], spread=True)


def with_replacement_items(chain: Chain, df: DataFrame, items: DataFrame) -> DataFrame:
    """Quantity of the row's product on the replacement invoice."""
    return chain.join(
        df, items, [("new_invoice", "newitem_invoice"), ("soi_product", "newitem_product")], spread_nulls=True
    )


def invoice_columns() -> dict[str, Column]:
    c = F.col
    return {
        "szFInvoiceId": b.replaced(c("new_invoice"), c("invoice_id"), c("new_invoice")),
        "decQtyInvoice": b.replaced(
            c("new_invoice"), number_or_zero(c("item_qty")), number_or_zero(c("newitem_qty"))
        ),
    }


def so_tracking_inquiry(
    tables: Tables,
    window: DateWindow,
    *,
    bonus_floor: DateFloor | None = None,
    latest_history_per_delivery: bool = False,
    salts: int | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """All items of the inquiries in `window`, with every document linked to them.

    The window is closed in this dataset; `bonus_floor` defaults to strictly
    after its start.
    """
    chain = Chain(tables, salts, UNUSED_BY_INQUIRY, stages)
    bonus_floor = bonus_floor or DateFloor(window.start, inclusive=False)
    replacements, replacement_items = replacement_sides(chain, latest_history_per_delivery)
    if stages is None:
        dated = [headers(chain, window, with_sales_order=kind, order_join="left") for kind in (True, False)]
        documents = [_documents(chain, df, replacements, kind) for df, kind in zip(dated, (True, False), strict=True)]
        name = ""
    else:
        # the documents of all inquiries are looked up once, whether they have a sales order or not
        name = stages.name("inquiry", window)
        both = both_headers(chain, window)
        stages.together(lambda: _scoped_deliveries(chain, both, "si_do", name), lambda: _scoped_approvals(chain, both, name))
        looked_up = chain.stored(f"documents-{name}", lambda: _documents(chain, both, replacements, None, name).drop(*FOUND_KEYS))
        stages.drop(f"approved-{name}")
        documents = [looked_up.where("linked"), looked_up.where("not linked").drop("has_bought", "poi_po")]
        dated = documents if stages.cuts(both) else [stages.mark_wide(df) for df in documents]
    rows = [
        _inquiry_rows(chain, df, scope, window, bonus_floor, replacement_items, kind, name)
        for df, scope, kind in zip(documents, dated, (True, False), strict=True)
    ]
    # The sales-order id tells the two apart, so no row occurs in both.
    return rows[0].unionByName(rows[1])


def _documents(chain: Chain, dated: DataFrame, replacements: DataFrame, with_sales_order: bool | None, name: str = "") -> DataFrame:
    """What the headers' own ids lead to: customer, approvals, note, delivery, invoice and logs."""
    df = chain.join(dated, chain.customers(), [("si_customer", "cust_id")], spread=True)
    df = with_approvals(chain, df, dated, name)
    notes = chain.side("delivery_notes", dated, "si_dn")
    df = chain.join(df, notes, [("si_dn", "dn_id")], spread=True)
    df = chain.join(df, chain.note_status(dated), [("si_dn", "closed_dn")], spread=True)
    if chain.stages is not None and not chain.stages.cuts(dated):  # so many headers that half of their shuffles go first
        df = chain.stored(f"approved-{name}", lambda plan=df.drop(*FOUND_KEYS): plan)
    df = with_deliveries(chain, df, "si_do", dated, name)
    df = with_replacements(chain, df, replacements)
    return _with_logs(chain, df, with_sales_order, dated)


def _inquiry_rows(
    chain: Chain,
    df: DataFrame,
    dated: DataFrame,
    window: DateWindow,
    bonus_floor: DateFloor,
    replacement_items: DataFrame,
    with_sales_order: bool,
    name: str,
) -> DataFrame:
    c = F.col
    if with_sales_order:
        if chain.stages is not None:
            df = df.repartition("si_so")  # else dealt by order and delivery first
        confirmations = chain.side("confirmations", dated, "si_so")
        df = chain.join(df, confirmations, [("si_so", "delv_so"), ("do_id", "delv_do")])
        orders = order_ids_in_window(chain, window, dated) if chain.stages is None or chain.stages.cuts(dated) else None
        items = chain.order_items(orders)
        if chain.stages is not None:  # from here on every join is by sales order
            items = with_products(chain, items, "soi_product")
        df = with_sales_items(chain, df, orders, items)
        discounted = chain.orders_since(bonus_floor, orders)
        df = chain.join_bonuses(df, chain.bonuses(discounted), "si_so")
        df = chain.join(
            df,
            chain.delivered(orders),
            [("si_so", "dlv_so"), ("delv_no", "dlv_no"), ("soi_product", "dlv_product")],
            )
    else:
        # No confirmation and no discount of this dataset is without a sales order.
        df = absent(df, delv_out="timestamp_ntz", delv_so=chain.tables.text, dlv_qty="int")
        df = with_purchase_items(chain, df, dated)
    side = "soi" if with_sales_order else "poi"
    if with_sales_order and chain.stages is not None:
        df = _with_documents_by_order(chain, df, replacement_items, dated, orders, name)
    else:
        df = _with_item_documents(chain, df, replacement_items, dated, name)
        df = with_products(chain, df, f"{side}_product")

    taxed = (c(f"{side}_taxable"), c(f"{side}_net"), c(f"{side}_tax"))
    if with_sales_order:
        discounts = {name: c(name) for name in DISCOUNT_NAMES}
    else:
        discounts = {name: F.lit(0) for name in DISCOUNT_NAMES}
        discounts["decDisc1DPP"] = b.discount_net(c("poi_discount"), *taxed)
        discounts["decDisc1Tax"] = b.discount_tax(c("poi_discount"), *taxed)
    invoice = invoice_columns()
    columns = {
        "szFPOid": b.order_number(c("so_customer_po"), c("si_po")),
        "gdApprovedId": c("so_approval"),
        "statusPO": text_or_default(c("po_status")),
        "szCustId": c("si_customer"),
        "IstatusFlag": number_or_zero(c("si_status")),
        "szFSoId": c("si_so"),
        "dtmCreatedPO": date_or_default(c("po_created")),
        "szFDoId": c("si_do"),
        "dtmCreatedSO": date_or_default(c("so_created")),
        "szFDnId": c("si_dn"),
        "dtmCreatedDO": date_or_default(c("delv_out")),
        "bSentWMS": c("si_sent_wms"),
        "dtmCreatedGR": date_or_default(c("receipt_created")),
        "dtmReceiptPOrec": date_or_default(c("receipt_date")),
        "szCarrierId": c("si_carrier"),
        "dtmDelivery": date_or_default(c("do_delivery")),
        "dtmCreatedInv": date_or_default(c("invoice_created")),
        "dtmSendWMS": date_or_default(c("transfer_time")),
        "custNm": c("cust_name"),
        "dtmOrder": date_or_default(c("so_ordered")),
        "szVehicleNo": c("si_vehicle"),
        "szDriverNm": c("si_driver"),
        "bvoidPO": flag_or_false(c("po_void")),
        "szPaymentTermId": c("so_payment_term"),
        "poDate": b.by_purchase_order(c("si_po"), c("so_created"), c("po_created")),
        "podatefilter": b.by_purchase_order(c("si_po"), c("so_ordered"), c("po_date")),
        "szFPoReceipt_sId": text_or_default(c("receipt_id")),
        "dtmreceipt": date_or_default(c("receipt_date")),
        "szProductId": c(f"{side}_product"),
        "decQty": c(f"{side}_qty"),
        "decPPN": c(f"{side}_tax"),
        "decDPP": c(f"{side}_net"),
        "decAmountPOSO": c(f"{side}_amount"),
        **discounts,
        "decPrice": b.net_price(c(f"{side}_price"), *taxed),
        "prodNm": c("product_name"),
        "decQtyReceipt": b.quantity_if_present(c("dn_id"), c("dni_qty")),
        "feedback": text_or_default(c("delv_so")),
        "decQtyDelivered": number_or_zero(c("dlv_qty")),
        "bStatusDN": flag_or_false(c("cl_applied")),
        **invoice,
        "szCustCat2": text_or_default(c("cust_category")),
        "szCustCat2Desc": text_or_default(c("category_name")),
        "dtmETA": c("si_eta"),
        "szDataCancelPO": text_or_default(c("cancel_data")),
        "currentApprovalLevel": b.approval_level(c("so_applied"), c("so_void"), c("max_level")),
        "bVoid": c("so_void"),
        **_approval_columns(),
        "MaxLastUpdated": date_or_default(c("dn_updated")),
    }
    return df.select([value.alias(name) for name, value in columns.items()]).distinct()


def _with_logs(chain: Chain, df: DataFrame, with_sales_order: bool | None, scope: DataFrame) -> DataFrame:
    """Transfer time and cancel data of the row's sales order; None: headers of both kinds, which stages keep together."""
    transfers = chain.side("transfers", scope, "si_so")
    cancels = chain.side("cancels", scope, "si_so").where("canceled").drop("canceled")
    if with_sales_order is None:
        df = chain.join(df, transfers.distinct(), [("si_so", "transfer_so")], spread=True)
        return chain.join(df, cancels.distinct(), [("si_so", "cancel_so")], spread=True)
    if with_sales_order:
        df = chain.join(df, transfers, [("si_so", "transfer_so")])
        return chain.join(df, cancels, [("si_so", "cancel_so")])
    # Log entries without an order id belong to all inquiries without one.
    transfers = chain.blank_only(transfers, "transfer_so").distinct()
    df = chain.join(df, transfers, [("si_so", "transfer_so")], spread=True)
    cancels = chain.blank_only(cancels, "cancel_so").distinct()
    return chain.join(df, cancels, [("si_so", "cancel_so")], spread=True)


def _with_item_documents(chain: Chain, df: DataFrame, replacement_items: DataFrame, scope: DataFrame, name: str) -> DataFrame:
    """Noted, invoiced and replacement-invoiced quantities of the row's sales item."""
    invoice_items = chain.side("invoice_items", _scoped_deliveries(chain, scope, "si_do", name), "do_invoice")
    note_items = chain.side("delivery_note_items", scope, "si_dn")
    # By the inquiry's note id: where the note is missing the quantity is zero anyway.
    df = chain.join(
        df,
        note_items,
        [("si_dn", "dni_dn"), ("soi_product", "dni_product")],
        spread=True,
    )
    df = chain.join(
        df,
        invoice_items,
        [("invoice_id", "item_invoice"), ("soi_product", "item_product"), ("soi_type", "item_type")],
        spread_nulls=True,
    )
    return with_replacement_items(chain, df, replacement_items)


def _with_documents_by_order(chain: Chain, df: DataFrame, replacement_items: DataFrame, documents: DataFrame, orders: DataFrame | None, name: str) -> DataFrame:
    """The same for the items of stored documents with a sales order; the wide rows stay where their order is."""
    # where the note is missing the quantity is zero anyway
    noted = documents.withColumn("si_dn", F.when(~is_blank(F.col("dn_id")), F.col("si_dn")))
    lines = chain.stored(f"lines-{name}", lambda: sales_lines(chain, noted, orders, "si_dn", "invoice_id", "new_invoice"))
    note_items = chain.side("delivery_note_items", documents, "si_dn")
    invoice_items = chain.side("invoice_items", _scoped_deliveries(chain, documents, "si_do", name), "do_invoice")
    df = by_order(chain, df, lines, note_items, [("si_dn", "dni_dn"), ("soi_product", "dni_product")], f"noted-{name}")
    on = [("invoice_id", "item_invoice"), ("soi_product", "item_product"), ("soi_type", "item_type")]
    df = by_order(chain, df, lines, invoice_items, on, f"invoiced-{name}")
    on = [("new_invoice", "newitem_invoice"), ("soi_product", "newitem_product")]
    return by_order(chain, df, lines, replacement_items, on, f"replaced-items-{name}")


def so_tracking_no_inquiry(
    tables: Tables, window: DateWindow, *, salts: int | None = None, stages: Stages | None = None
) -> DataFrame:
    """Items of the sales orders in `window` that no inquiry names."""
    c = F.col
    chain = Chain(tables, salts, UNUSED_BY_NO_INQUIRY, stages)
    in_window = chain.in_window(chain.orders(), window, "so_ordered", "so_month")
    name = "" if stages is None else stages.name("unnamed", window)
    unnamed = chain.stored(name, lambda: anti_join_null_aware(in_window, chain.inquiry_orders(), "so_id", "si_so", chain.side("inquiry_orders")))
    if stages is not None:
        stages.watch(name, unnamed, ("so_customer", "so_approval", "so_do"))
    customers = chain.customers()
    df = chain.join(unnamed, customers, [("so_customer", "cust_id")], spread=True)
    df = with_approvals(chain, df, unnamed, name)
    df = with_deliveries(chain, df, "so_do", unnamed, name)
    scope = (in_window if stages is None else unnamed).select(c("so_id").alias("scope_so")).distinct()
    items = chain.order_items(scope).where(not_empty(c("soi_product")))
    df = chain.join(df, items, [("so_id", "soi_so")])
    df = chain.join_bonuses(df, chain.bonuses(scope), "so_id")
    df = with_products(chain, df, "soi_product")
    columns = {
        "szFPOid": trimmed(c("so_customer_po")),
        "gdApprovedId": c("so_approval"),
        "szOrdertypeId": c("so_type"),
        "szCustId": c("so_customer"),
        "szFSoId": c("so_id"),
        "szDoId": c("do_id"),
        "szCarrierId": c("do_carrier"),
        "custNm": c("cust_name"),
        "dtmOrder": date_or_parts(c("so_created")),
        "szVehicleNumber": c("do_vehicle"),
        "dtmCreatedDO": date_or_default(c("do_created")),
        "szDriverName": c("do_driver"),
        "dtmCreatedSO": date_or_default(c("so_created")),
        "dtmCreatedInv": date_or_default(c("invoice_created")),
        "szPaymentTermId": c("so_payment_term"),
        "dtmDelivery": date_or_default(c("do_delivery")),
        "szProductId": c("soi_product"),
        "decQty": b.quantity_or_units(c("soi_qty"), c("soi_units")),
        "decPPN": c("soi_tax"),
        "decDPP": c("soi_net"),
        "currentApprovalLevel": b.approval_level_unlinked(
            c("so_applied"), c("so_void"), c("max_level")
        ),
        "decPrice": b.net_price(c("soi_price"), c("soi_taxable"), c("soi_net"), c("soi_tax")),
        **_approval_columns(),
        **{name: c(name) for name in DISCOUNT_NAMES},
        "prodNm": c("product_name"),
        "szCustCat2": text_or_default(c("cust_category")),
        "szCustCat2Desc": text_or_default(c("category_name")),
        "bVoid": c("so_void"),
    }
    return df.select([value.alias(name) for name, value in columns.items()]).distinct()
