"""The registered queries: each dataset, and each operator on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderweave import jobs
from orderweave.functions import business as b
from orderweave.functions.nulls import (
    date_or_default,
    date_or_parts,
    flag_or_false,
    is_blank,
    not_empty,
    number_or_zero,
    text_or_default,
    trimmed,
)
from orderweave.functions.windows import DateFloor, DateWindow, month_to_date
from orderweave.operators import rollups
from orderweave.operators.joins import anti_join_null_aware
from orderweave.operators.ranking import highest, join_top_row
from orderweave.operators.state import RollupState
from orderweave.plans import (
    Stages,
    enrich_with_distributor,
    po_tracking_by_delivery,
    po_tracking_month,
    so_tracking_inquiry,
    so_tracking_no_inquiry,
)
from orderweave.plans.chain import Chain
from orderweave.plans.po_tracking import CHANNELS, RESERVED, not_canceled, not_rejected
from orderweave.plans.so_tracking import (
    invoice_columns,
    replacement_sides,
    with_approvals,
    with_deliveries,
    with_replacement_items,
    with_replacements,
)
from orderweave.plans.spine import (
    BOUGHT,
    bought_flags,
    dated_inquiries,
    is_sold,
)
from orderweave.session import scratch_folder, tune
from orderweave.sinks import Target, replace, replace_period, replace_periods, with_source_text_dates, with_text_dates
from orderweave.sources import Tables

from .bridge import bridge_tables, skewed_views
from .money import money_on_grid, on_grid

HALF_YEAR = DateWindow("1998-01-01", "1998-07-01")
HALF_YEAR_CLOSED = DateWindow("1998-01-01", "1998-07-01", closed=True)
DELIVERY_QUARTER = DateWindow("1998-04-01", "1998-07-01")
ALL_DATES = DateWindow("1990-01-01", "2010-01-01")
ALL_DATES_CLOSED = DateWindow("1990-01-01", "2010-01-01", closed=True)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AMOUNTS = ("amount_incl_ppn_before_discount", "nett_amount_incl_ppn")
WIDE_AMOUNTS = ("decPPN", "decDPP", "decPrice", *rollups.DISCOUNT_NAMES)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(bridge_tables(tune(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


# The four datasets, over a half year and over all dates.


def _month(t: Tables, window: DateWindow) -> DataFrame:
    return money_on_grid(po_tracking_month(t, window, stages=Stages(t.spark)), *AMOUNTS)


def _by_delivery(t: Tables, window: DateWindow, delivered: DateWindow) -> DataFrame:
    return money_on_grid(po_tracking_by_delivery(t, window, delivered, stages=Stages(t.spark)), *AMOUNTS)


def _inquiry(t: Tables, window: DateWindow) -> DataFrame:
    return money_on_grid(so_tracking_inquiry(t, window, stages=Stages(t.spark)), "decAmountPOSO", *WIDE_AMOUNTS)


def _no_inquiry(t: Tables, window: DateWindow) -> DataFrame:
    return money_on_grid(so_tracking_no_inquiry(t, window, stages=Stages(t.spark)), *WIDE_AMOUNTS)


@query
def po_tracking_mtd(t: Tables) -> DataFrame:
    return _month(t, HALF_YEAR)


@query
def po_tracking_mtd_all_dates(t: Tables) -> DataFrame:
    return _month(t, ALL_DATES)


@query
def po_tracking_3m(t: Tables) -> DataFrame:
    return _by_delivery(t, HALF_YEAR, DELIVERY_QUARTER)


@query
def po_tracking_3m_all_dates(t: Tables) -> DataFrame:
    return _by_delivery(t, ALL_DATES, ALL_DATES)


@query
def so_tracking_inquiries(t: Tables) -> DataFrame:
    return _inquiry(t, HALF_YEAR_CLOSED)


QUERIES["so_tracking_inquiry"] = QUERIES.pop("so_tracking_inquiries")


@query
def so_tracking_inquiry_all_dates(t: Tables) -> DataFrame:
    return _inquiry(t, ALL_DATES_CLOSED)


@query
def so_tracking_without_inquiry(t: Tables) -> DataFrame:
    return _no_inquiry(t, HALF_YEAR)


QUERIES["so_tracking_no_inquiry"] = QUERIES.pop("so_tracking_without_inquiry")


@query
def so_tracking_no_inquiry_all_dates(t: Tables) -> DataFrame:
    return _no_inquiry(t, ALL_DATES)


# The same datasets over awkward ids, with few salts: ids of more than a few rows count as heavy.


SKEWED = skewed_views()
HEAVY = 40


def _skewed(name: str, build: Callable[[Tables], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(bridge_tables(tune(spark), sf_dir, SKEWED))

    QUERIES[name] = run


_skewed(
    "po_tracking_mtd_skewed",
    lambda t: money_on_grid(po_tracking_month(t, HALF_YEAR, salts=3, stages=Stages(t.spark, heavy_rows=HEAVY)), *AMOUNTS),
)
_skewed(
    "po_tracking_3m_skewed",
    lambda t: money_on_grid(po_tracking_by_delivery(t, HALF_YEAR, DELIVERY_QUARTER, salts=3, stages=Stages(t.spark, heavy_rows=HEAVY)), *AMOUNTS),
)
_skewed(
    "so_tracking_inquiry_skewed",
    lambda t: money_on_grid(so_tracking_inquiry(t, HALF_YEAR_CLOSED, salts=3, stages=Stages(t.spark, heavy_rows=HEAVY)), "decAmountPOSO", *WIDE_AMOUNTS),
)
_skewed(
    "so_tracking_no_inquiry_skewed",
    lambda t: money_on_grid(so_tracking_no_inquiry(t, HALF_YEAR, salts=3, stages=Stages(t.spark, heavy_rows=HEAVY)), *WIDE_AMOUNTS),
)


def _untidy(df: DataFrame, seed: int) -> DataFrame:
    """Some texts in lower case and with trailing blanks, differently in every table."""
    other = lambda c: F.concat(F.lower(c), F.lit("  "))
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns(
        {c: F.when(F.pmod(F.xxhash64(F.lit(seed), c), F.lit(2)) == 0, other(F.col(c))).otherwise(F.col(c)) for c in texts}
    )


@query
def po_tracking_mtd_ignore_case(t: Tables) -> DataFrame:
    """The month dataset over untidy texts, compared without case and trailing blanks; shown tidy."""
    untidy = Tables(t.spark, lambda name: _untidy(t[name], len(name))).with_padded_keys(ignore_case=True)
    df = _month(untidy, HALF_YEAR)
    plain = lambda c: F.upper(F.rtrim(F.collate(c, "UTF8_BINARY")))
    texts = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("string")]
    return df.withColumns({c: plain(c) for c in texts})


@query
def four_datasets(t: Tables) -> DataFrame:
    """All four datasets of a month loaded by one run, read back: what tells their rows apart."""
    folder = scratch_folder(t.spark)
    targets = {name: Target(path=f"{folder}/{name}") for name in jobs.TARGETS}
    jobs.run_all(t, date(1998, 3, 31), targets)
    loaded = {name: target.read(t.spark) for name, target in targets.items()}
    none = F.lit(None).cast("string")
    keys = {
        "month": ("purchase_order_number", "sales_order_number", "customer_id", "product_id"),
        "quarter": ("purchase_order_number", "sales_order_number", "customer_id", "product_id"),
        "inquiry": ("szFPOid", "szFSoId", "szCustId", "szProductId"),
        "no-inquiry": ("szFPOid", "szFSoId", "szCustId", "szProductId"),
    }
    money = {"month": "nett_amount_incl_ppn", "quarter": "nett_amount_incl_ppn", "inquiry": "decDisc1DPP", "no-inquiry": "decDisc1DPP"}
    delivered = {"quarter": F.col("qty_delivered"), "inquiry": F.col("decQtyDelivered")}
    found = None
    for name, df in loaded.items():
        columns = [F.col(c).alias(k) for c, k in zip(keys[name], ("po", "so", "customer", "product"), strict=True)]
        amount = on_grid(F.col(money[name]).cast("double")).alias("amount")
        part = df.select(F.lit(name).alias("dataset"), *columns, amount, delivered.get(name, none).cast("double").alias("delivered"))
        found = part if found is None else found.unionByName(part)
    return found


# Roll-ups kept up to date.


@query
def bonus_state(t: Tables) -> DataFrame:
    """The discount roll-up as two refreshes leave it, the second after discounts of closed months came in."""
    late = F.pmod(F.col("shItemNumber"), F.lit(3)) == 1
    orders = t["sales_order"].select("szFSoId", "dtmOrder")
    target = Target(path=f"{scratch_folder(t.spark)}/bonuses")

    def state(known: DataFrame) -> RollupState:
        return RollupState(target, "szFSoId", lambda ids: rollups.bonus_rollup(t["sales_order_item"], known, ids))

    state(t["bonus_source"].where(~late)).refresh(orders, "dtmOrder")
    touched = orders.join(t["bonus_source"].where(late).select("szFSoId").distinct(), "szFSoId", "left_semi")
    state(t["bonus_source"]).refresh(touched, "dtmOrder")
    return money_on_grid(state(t["bonus_source"]).read(t.spark), *rollups.DISCOUNT_NAMES)


# Projections.


def _linked(chain: Chain) -> DataFrame:
    """Inquiries with their sales order and purchase order, if any."""
    df = chain.join(chain.inquiries(), chain.orders(), [("si_so", "so_id")], spread=True)
    return chain.join(df, chain.purchase_orders(), [("si_po", "po_id")], spread=True)


@query
def null_defaults(t: Tables) -> DataFrame:
    chain, c = Chain(t), F.col
    df = _linked(chain)
    df = chain.join(df, chain.confirmations(), [("si_so", "delv_so"), ("si_do", "delv_do")])
    return df.select(
        "si_so",
        "si_po",
        "si_do",
        text_or_default(c("po_status")).alias("status"),
        number_or_zero(c("si_status")).alias("status_flag"),
        date_or_default(c("po_created")).alias("po_created"),
        date_or_parts(c("so_created")).alias("so_created"),
        flag_or_false(c("po_void")).alias("po_void"),
        text_or_default(c("delv_so")).alias("feedback"),
        date_or_default(c("delv_out")).alias("delivered"),
    )


@query
def blank_fallback(t: Tables) -> DataFrame:
    chain, c = Chain(t), F.col
    df = chain.join(chain.inquiries(), chain.orders(), [("si_so", "so_id")], spread=True)
    return df.select(
        "si_so",
        "si_po",
        is_blank(c("so_customer_po")).alias("is_blank"),
        b.order_number(c("so_customer_po"), c("si_po")).alias("order_number"),
        trimmed(c("so_customer_po")).alias("customer_po"),
    )


@query
def source_switch(t: Tables) -> DataFrame:
    """Items from the sales order, or from the purchase order where there is none."""
    chain, c = Chain(t), F.col
    linked = _linked(chain)
    sales = chain.join(linked.where(~is_blank(c("si_so"))), chain.order_items(), [("so_id", "soi_so")])
    sales = chain.join_bonuses(sales, chain.bonuses(), "so_id")
    bought = chain.join(
        linked.where(is_blank(c("si_so"))), chain.purchase_items(), [("po_id", "poi_po")]
    )
    df = sales.unionByName(bought, allowMissingColumns=True)

    def switch(name: str):
        return b.by_sales_order(c("si_so"), c(f"poi_{name}"), c(f"soi_{name}")).alias(name)

    df = df.select(
        "si_so",
        "si_po",
        b.by_purchase_order(c("si_po"), c("so_created"), c("po_created")).alias("order_date"),
        b.by_purchase_order(c("si_po"), c("so_ordered"), c("po_date")).alias("filter_date"),
        *[switch(n) for n in ("product", "qty", "tax", "net", "amount")],
        *[b.by_sales_order(c("si_so"), F.lit(0), c(n)).alias(n) for n in rollups.DISCOUNT_NAMES[2:]],
    ).distinct()
    return money_on_grid(df, "tax", "net", "amount", *rollups.DISCOUNT_NAMES[2:])


@query
def tax_split(t: Tables) -> DataFrame:
    c = F.col
    taxed = (c("decDiscount"), c("bTaxable"), c("decDPP"), c("decPPN"))
    df = t["purchase_order_item"].select(
        "szFPo_sId",
        "szProductId",
        "decQty",
        b.discount_net(*taxed).alias("discount_net"),
        b.discount_tax(*taxed).alias("discount_tax"),
    )
    return money_on_grid(df, "discount_net", "discount_tax")


@query
def net_price(t: Tables) -> DataFrame:
    c = F.col
    sold = t["sales_order_item"].select(
        c("szFSoId").alias("document"),
        "szProductId",
        b.net_price(c("decPrice"), c("bTaxable"), c("decDPP"), c("decTax")).alias("net_price"),
    )
    bought = t["purchase_order_item"].select(
        c("szFPo_sId").alias("document"),
        "szProductId",
        b.net_price(c("decPrice"), c("bTaxable"), c("decDPP"), c("decPPN")).alias("net_price"),
    )
    return money_on_grid(sold.unionByName(bought), "net_price")


@query
def net_amount(t: Tables) -> DataFrame:
    chain, c = Chain(t), F.col
    df = chain.join_bonuses(chain.order_items(), chain.bonuses(), "soi_so")
    df = df.select(
        "soi_so",
        "soi_product",
        b.net_amount(c("soi_amount"), c("decDiscFakturDPP"), c("decDiscFakturTax")).alias("net_amount"),
    )
    return money_on_grid(df, "net_amount")


@query
def conditional_qty(t: Tables) -> DataFrame:
    chain, c = Chain(t), F.col
    df = chain.join(chain.inquiries(), chain.delivery_notes(), [("si_dn", "dn_id")], spread=True)
    df = chain.join(df, chain.delivery_note_items(), [("dn_id", "dni_dn")])
    return df.select(
        "si_so",
        "si_dn",
        "dni_product",
        b.quantity_if_present(c("dn_id"), c("dni_qty")).alias("noted_qty"),
    )


@query
def unit_fallback_qty(t: Tables) -> DataFrame:
    return t["sales_order_item"].select(
        "szFSoId",
        "szProductId",
        b.quantity_or_units(F.col("decQty"), F.col("decUomQty")).alias("qty"),
    )


def _history(t: Tables, per_key: bool) -> DataFrame:
    chain = Chain(t)
    deliveries = chain.pick("delivery_order", si_do="szDoId")
    df = with_deliveries(chain, deliveries, "si_do")
    items = chain.pick(
        "invoice_item", item_invoice="szFInvoiceId", soi_product="szProductId", item_qty="decQty"
    )
    df = chain.join(df, items, [("invoice_id", "item_invoice")], spread_nulls=True)
    replacements, items = replacement_sides(chain, per_key)
    df = with_replacements(chain, df, replacements)
    df = with_replacement_items(chain, df, items)
    columns = [value.alias(name) for name, value in invoice_columns().items()]
    return df.select("do_id", "soi_product", *columns).distinct()


@query
def history_fallback(t: Tables) -> DataFrame:
    return _history(t, per_key=True)


@query
def history_fallback_global(t: Tables) -> DataFrame:
    return _history(t, per_key=False)


def _levels(t: Tables, level: Callable) -> DataFrame:
    c = F.col
    levels = highest(t["approval_item"], "gdApprovedId", "btApprovedLevel", "max_level")
    df = t["sales_order"].join(levels, "gdApprovedId", "left")
    return df.select("szFSoId", level(c("bApplied"), c("bVoid"), c("max_level")).alias("level"))


@query
def approval_level(t: Tables) -> DataFrame:
    return _levels(t, b.approval_level)


@query
def approval_level_mt(t: Tables) -> DataFrame:
    return _levels(t, b.approval_level_unlinked)


@query
def concat_key(t: Tables) -> DataFrame:
    chain, c = Chain(t), F.col
    df = chain.join(chain.inquiries(), chain.orders(), [("si_so", "so_id")], spread=True)
    df = chain.join(df, chain.order_items(), [("so_id", "soi_so")])
    number = b.order_number(c("so_customer_po"), c("si_po"))
    return df.select(
        "si_so",
        b.joined_key(number, c("soi_product")).alias("line_key"),
        b.joined_key(c("so_customer_po"), c("so_payment_term")).alias("term_key"),
    )


# Filters.


@query
def or_across_tables(t: Tables) -> DataFrame:
    chain = Chain(t)
    df = chain.join(chain.inquiries(), chain.order_items(), [("si_so", "soi_so")], spread=True)
    df = chain.join(df, bought_flags(chain), [("si_po", "poi_po")], spread=True)
    return df.where(is_sold() | F.col("has_bought")).select("si_so", "si_po", "soi_product").distinct()


def _dated(t: Tables, window: DateWindow, created: DateWindow | None) -> DataFrame:
    chain = Chain(t)
    orders = chain.orders()
    if created is not None:
        orders = orders.where(created.contains(F.col("so_created")))
    rows = None
    for with_sales_order in (True, False):
        df = dated_inquiries(
            chain,
            window,
            orders,
            with_sales_order=with_sales_order,
            order_join="left" if created is None else "inner",
        ).select("si_so", "si_po", "so_ordered", "so_created", "po_date", "receipt_id")
        rows = df if rows is None else rows.unionByName(df)
    return rows.distinct()


@query
def conditional_window(t: Tables) -> DataFrame:
    return _dated(t, HALF_YEAR, created=HALF_YEAR)


@query
def conditional_window_closed(t: Tables) -> DataFrame:
    return _dated(t, HALF_YEAR_CLOSED, created=None)


@query
def param_window(t: Tables) -> DataFrame:
    return t["sales_order"].where(HALF_YEAR.contains(F.col("dtmOrder"))).select(
        "szFSoId", "szCustId", "dtmOrder"
    )


@query
def delivery_window(t: Tables) -> DataFrame:
    return t["delivery_confirmation"].where(DELIVERY_QUARTER.contains(F.col("outTime")))


@query
def channel_filter(t: Tables) -> DataFrame:
    return Chain(t).customers().where(F.col("category_name").isin(*CHANNELS)).select(
        "cust_id", "cust_name", "category_name"
    )


@query
def null_safe_exclude(t: Tables) -> DataFrame:
    chain = Chain(t)
    df = chain.orders().withColumn("si_so", F.col("so_id"))
    df = not_rejected(chain, not_canceled(chain, df, spread=False))
    names = {"szFSoId": "so_id", "bAlreadyTransferred": "canceled", "bRejected": "rejected"}
    return df.select([F.col(old).alias(new) for new, old in names.items()])


@query
def not_like(t: Tables) -> DataFrame:
    return t["sales_order"].where(b.contains_none(F.col("szCustPoId"), RESERVED)).select(
        "szFSoId", "szCustPoId"
    )


@query
def not_in_anti(t: Tables) -> DataFrame:
    inquiries = t["sales_inquiry"].select(F.col("szFSoId").alias("inquiry_so"))
    df = anti_join_null_aware(t["sales_order"], inquiries, "szFSoId", "inquiry_so")
    return df.select("szFSoId", "szCustId", "dtmOrder")


# Joins.


@query
def left_join_chain(t: Tables) -> DataFrame:
    return _linked(Chain(t)).select(
        "si_so", "si_po", "so_id", "so_customer_po", "so_ordered", "po_id", "po_date", "po_status"
    )


@query
def header_item_fanout(t: Tables) -> DataFrame:
    chain = Chain(t)
    return chain.join(chain.orders(), chain.order_items(), [("so_id", "soi_so")]).select(
        "so_id", "so_ordered", "soi_product", "soi_qty", "soi_type"
    )


@query
def dim_lookup(t: Tables) -> DataFrame:
    chain = Chain(t)
    df = chain.join(chain.orders(), chain.order_items(), [("so_id", "soi_so")])
    df = chain.join(df, chain.products(), [("soi_product", "product_id")])
    df = chain.join(df, chain.customers(), [("so_customer", "cust_id")])
    return df.select("so_id", "soi_product", "product_name", "cust_name", "category_name")


@query
def left_join_on_filter(t: Tables) -> DataFrame:
    chain, c = Chain(t), F.col
    receipts = chain.receipts().where(not_empty(c("receipt_po")))
    df = chain.join(chain.purchase_orders(), receipts, [("po_id", "receipt_po")])
    df = df.withColumn("so_no", F.regexp_replace("po_id", "^PO", "SO"))
    df = chain.join(df, chain.transfers(), [("so_no", "transfer_so")])
    df = df.withColumnsRenamed({"transfer_so": "log_so", "transfer_time": "log_time"})
    return df.select("po_id", "receipt_id", "receipt_date", "log_so", "log_time")


@query
def composite_key_join(t: Tables) -> DataFrame:
    chain = Chain(t)
    df = chain.inquiries().where(~is_blank(F.col("si_so")))
    df = with_deliveries(chain, df, "si_do")
    df = chain.join(df, chain.order_items(), [("si_so", "soi_so")])
    df = chain.join(
        df,
        chain.delivery_note_items(),
        [("si_dn", "dni_dn"), ("soi_product", "dni_product")],
        spread=True,
    )
    items = chain.pick(
        "invoice_item",
        item_invoice="szFInvoiceId",
        item_product="szProductId",
        item_type="szOrderItemTypeId",
        item_qty="decQty",
    )
    df = chain.join(
        df,
        items,
        [("invoice_id", "item_invoice"), ("soi_product", "item_product"), ("soi_type", "item_type")],
    )
    return df.select("si_so", "soi_product", "soi_type", "dni_qty", "invoice_id", "item_qty")


@query
def self_alias_join(t: Tables) -> DataFrame:
    """Deliveries and invoices each read twice: the original and the replacing one."""
    chain = Chain(t)
    old = chain.pick("delivery_order", do_id="szDoId", do_invoice="szFInvoiceId")
    history = chain.pick("delivery_history", new_do="szDoId", old_do="szDoIdOld")
    new = chain.pick("delivery_order", newdo_id="szDoId", newdo_invoice="szFInvoiceId")
    first = chain.pick("invoice", invoice_id="szFInvoiceId", invoice_created="dtmCreated")
    second = chain.pick("invoice", new_invoice="szFInvoiceId", new_created="dtmCreated")
    df = chain.join(old, history, [("do_id", "old_do")])
    df = chain.join(df, new, [("new_do", "newdo_id")])
    df = chain.join(df, first, [("do_invoice", "invoice_id")], spread=True)
    df = chain.join(df, second, [("newdo_invoice", "new_invoice")], spread=True)
    return df.select("do_id", "newdo_id", "invoice_id", "invoice_created", "new_invoice", "new_created")


@query
def top1_correlated(t: Tables) -> DataFrame:
    chain = Chain(t)
    notes = chain.pick("sales_inquiry", si_so="szFSoId", si_dn="szFDnId")
    df = chain.join(notes, chain.note_status(), [("si_dn", "closed_dn")], spread=True)
    return df.select("si_so", "si_dn", flag_or_false(F.col("cl_applied")).alias("closed"))


@query
def top1_global_join(t: Tables) -> DataFrame:
    items = t["approval_item"].select(F.col("gdApprovedId").alias("top_id"), "btApprovedLevel")
    df = join_top_row(
        t["sales_order"],
        items,
        ("gdApprovedId", "top_id"),
        [F.desc_nulls_last("btApprovedLevel"), F.asc("top_id")],
    )
    return df.select("szFSoId", "gdApprovedId", "top_id", F.col("btApprovedLevel").cast("int").alias("level"))


@query
def top1_global_history(t: Tables) -> DataFrame:
    history = t["delivery_history"].select(
        F.col("szDoId").alias("new_do"), F.col("szDoIdOld").alias("old_do"), "dtmLastUpdated"
    )
    df = join_top_row(
        t["delivery_order"],
        history,
        ("szDoId", "old_do"),
        [F.desc_nulls_last("dtmLastUpdated"), F.asc("old_do"), F.asc("new_do")],
    )
    return df.select("szDoId", "old_do", "new_do")


@query
def approval_pivot(t: Tables) -> DataFrame:
    chain = Chain(t)
    df = with_approvals(chain, chain.orders())
    levels = {f"{new}_{n}": f"gd{n}_{old}" for new, old in (("dtmApproved", "time"), ("bApproved", "approved")) for n in (1, 2, 3)}
    names = {"szFSoId": "so_id", "gdApprovedId": "so_approval", **levels}
    return df.select([F.col(old).alias(new) for new, old in names.items()])


@query
def unused_join_elim(t: Tables) -> DataFrame:
    """The joins without an output column are left out: DISTINCT hides their copies."""
    return _linked(Chain(t)).select("si_so", "si_po", "so_ordered", "po_date").distinct()


@query
def outer_to_inner(t: Tables) -> DataFrame:
    """A filter on the optional side makes the left joins inner."""
    chain, c = Chain(t), F.col
    orders = chain.orders().where(HALF_YEAR.contains(c("so_created")))
    inquiries = chain.inquiries().where(~is_blank(c("si_so")))
    df = chain.join(inquiries, orders, [("si_so", "so_id")], "inner")
    customers = chain.customers().where(c("category_name").isin(*CHANNELS))
    df = chain.join(df, customers, [("si_customer", "cust_id")], "inner")
    return df.select("si_so", "so_created", "cust_name", "category_name")


# Aggregations.


@query
def delivered_qty(t: Tables) -> DataFrame:
    """Delivered quantity of every ordered product, zero if none."""
    chain, c = Chain(t), F.col
    orders = chain.pick("sales_order", si_so="szFSoId")
    df = chain.join(orders, chain.confirmations(), [("si_so", "delv_so")])
    df = chain.join(df, chain.order_items(), [("si_so", "soi_so")])
    df = chain.join(
        df,
        chain.delivered(),
        [("si_so", "dlv_so"), ("delv_no", "dlv_no"), ("soi_product", "dlv_product")],
    )
    return df.select("si_so", "delv_no", "soi_product", number_or_zero(c("dlv_qty")).alias("qty"))


@query
def invoice_qty(t: Tables) -> DataFrame:
    return rollups.invoiced_quantity(t["invoice_item"])


@query
def bonus_rollup(t: Tables) -> DataFrame:
    stages = Stages(t.spark)
    stages.watch("bonuses", t["bonus_source"], ("szFSoId",))
    df = rollups.bonus_rollup(t["sales_order_item"], t["bonus_source"], heavy=stages.heavy("szFSoId"))
    return money_on_grid(df, *rollups.DISCOUNT_NAMES)


@query
def bonus_rollup_since(t: Tables) -> DataFrame:
    since = DateFloor("1998-01-01", inclusive=False)
    orders = t["sales_order"].where(since.admits(F.col("dtmOrder"))).select("szFSoId")
    df = rollups.bonus_rollup(t["sales_order_item"], t["bonus_source"], orders)
    return money_on_grid(df, *rollups.DISCOUNT_NAMES)


@query
def buy_item_flag(t: Tables) -> DataFrame:
    return rollups.purchase_flags(t["purchase_order_item"], "szFPo_sId", "purchaseItemTypeId", BOUGHT)


@query
def select_distinct(t: Tables) -> DataFrame:
    return t["sales_order_item"].select(
        "szFSoId", "szParentId", "szPaymentType", "szOrderItemTypeId", "bTaxable"
    ).distinct()


# Sinks.


@query
def date_to_text(t: Tables) -> DataFrame:
    orders = t["purchase_order"].select("szFPo_sId", F.col("dtmCreated").alias("date_created"), "dtmPO")
    return with_text_dates(orders)


@query
def date_to_text_as_source(t: Tables) -> DataFrame:
    """Dates in the form that the whole column asks for: days, seconds, and a column with gaps."""
    c = F.col("dtmCreated")
    orders = t["purchase_order"].select(
        "szFPo_sId",
        F.date_trunc("day", c).cast("timestamp_ntz").alias("created_day"),
        (F.date_trunc("day", c).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, length(szFPo_sId))")).alias("created_second"),
        F.when(F.col("szFPo_sId").endswith("7"), c).alias("created_some"),
    )
    return with_source_text_dates(orders, ("created_day", "created_second", "created_some"))


@query
def sink_overwrite(t: Tables) -> DataFrame:
    """Loaded twice: the second load replaces the first."""
    target = Target(path=f"{scratch_folder(t.spark)}/po_tracking")
    orders = t["purchase_order"].select("szFPo_sId", F.col("dtmCreated").alias("date_created"))
    jobs.load(orders, target)
    jobs.load(orders, target)
    return target.read(t.spark)


RERUN = (date(1998, 1, 1), date(1998, 2, 1))


def _ordered_in(t: Tables, month: date, version: int) -> DataFrame:
    orders = t["sales_order"].select("szFSoId", "dtmOrder", F.lit(version).alias("version"))
    return orders.where(month_to_date(month).contains(F.col("dtmOrder")))


def _loaded(t: Tables, target: Target) -> DataFrame:
    return target.read(t.spark).select(
        "szFSoId", "dtmOrder", "version", F.col("period").cast("string").alias("period")
    )


@query
def sink_month_partition(t: Tables) -> DataFrame:
    """All months of the table are loaded, then those of one half year are loaded again."""
    target = Target(path=f"{scratch_folder(t.spark)}/sales_order")
    orders = t["sales_order"].select("szFSoId", "dtmOrder", F.lit(1).alias("version"))
    replace_periods(orders, target, "dtmOrder")
    again = orders.where(HALF_YEAR.contains(F.col("dtmOrder"))).withColumn("version", F.lit(2))
    replace_periods(again, target, "dtmOrder")
    return _loaded(t, target)


@query
def sink_month_rerun(t: Tables) -> DataFrame:
    """A month whose run also holds orders of the next month's first days is loaded again after that month."""
    target = Target(path=f"{scratch_folder(t.spark)}/sales_order")
    first, second = RERUN
    overlap = DateWindow("1998-02-01", "1998-02-04")
    late = t["sales_order"].where(overlap.contains(F.col("dtmOrder")))

    def run(version: int) -> DataFrame:
        return _ordered_in(t, first, version).unionByName(
            late.select("szFSoId", "dtmOrder", F.lit(version).alias("version"))
        )

    replace_period(run(1), target, first)
    replace_period(_ordered_in(t, second, 1), target, second)
    replace_period(run(2), target, first)
    return _loaded(t, target)


@query
def shipment_load(t: Tables) -> DataFrame:
    """A table copied into the warehouse as it is; delivery orders stand in for shipments."""
    target = Target(path=f"{scratch_folder(t.spark)}/shipment")
    replace(t["delivery_order"], target)
    return target.read(t.spark)


def _distributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("distributor_id"),
        F.col("s_name").alias("distributor_name"),
    )


def enrich_distributor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month dataset joined to suppliers, who stand in for distributors."""
    dataset = po_tracking_month(bridge_tables(tune(spark), sf_dir), ALL_DATES).select(
        "purchase_order_number", "sales_order_number", "customer_id", "product_id"
    )
    distributors = _distributors(spark, sf_dir)
    df = enrich_with_distributor(dataset, distributors, ("customer_id", "distributor_id"))
    return df.distinct()


QUERIES["enrich_distributor"] = enrich_distributor
