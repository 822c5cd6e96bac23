"""Frames and joins of one dataset plan.

The datasets are chains of joins that end in a DISTINCT over all columns.  So a
side may be de-duplicated early and a join that adds no column may be left out:
neither can change the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import is_empty_id
from ..functions.windows import DateFloor, DateWindow
from ..operators import rollups
from ..operators.skew import skew_join
from ..sources import Tables
from ..sources.schema import STORED_MONTH
from .stages import Stages


#: Frames of side tables that a run cuts once for all its datasets: their id, and the kind of the run's ids it is one of.
SIDES = {
    "orders": ("so_id", "order"),
    "order_lines": ("soi_so", "order"),
    "bonus_source": ("szFSoId", "order"),
    "delivered_items": ("custOrderNo", "order"),
    "confirmations": ("delv_so", "order"),
    "transfers": ("transfer_so", "order"),
    "cancels": ("cancel_so", "order"),
    "inquiry_orders": ("si_so", "order"),
    "rejections": ("rejected_id", "approval"),
    "approval_items": ("gd_id", "approval"),
    "deliveries": ("do_id", "delivery"),
    "delivery_notes": ("dn_id", "note"),
    "delivery_note_items": ("dni_dn", "note"),
    "closing_items": ("closed_dn", "note"),
    "purchase_items": ("poi_po", "purchase"),
    "invoices": ("invoice_id", "invoice"),
    "invoice_items": ("item_invoice", "invoice"),
}

# Ids that tell rows with the same blank or heavy key apart.
SALT_COLUMNS = ("si_so", "si_po", "si_do", "si_dn", "si_customer", "so_id", "do_id", "soi_product", "poi_product")


class Chain:
    """Without stages, building a plan starts no job: what depends on the data is decided by its joins.

    `salts` is how finely blank ids are split, by default as the shuffles are.
    `unused` names columns of the frames below that the dataset does not need.
    Catalyst prunes columns by itself, but not below a salt or an early DISTINCT.
    """

    def __init__(
        self,
        tables: Tables,
        salts: int | None = None,
        unused: frozenset[str] = frozenset(),
        stages: Stages | None = None,
    ):
        self.tables = tables
        self.stages = stages
        self.unused = unused
        self.salts = salts or int(tables.spark.conf.get("spark.sql.shuffle.partitions"))

    def pick(self, table: str, **names: str) -> DataFrame:
        """Columns of a table under names that are unique in the chain."""
        names = {new: old for new, old in names.items() if new not in self.unused}
        return self.tables[table].selectExpr(*[f"{old} as {new}" for new, old in names.items()])

    def blank_only(self, df: DataFrame, key: str) -> DataFrame:
        """Rows with a blank id: none in most tables, found by the scan."""
        return df.where(is_empty_id(F.col(key)))

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The frame; computed once for all plans that share the stages."""
        return self.stages.stored(name, build) if self.stages else build()

    def cut(self, side: DataFrame, key: str, scope: DataFrame | None, column: str) -> DataFrame:
        """Rows of a side table whose id occurs in a stored header; all rows without stages, or if the headers are of a wide window.

        A left join to the header cannot use the others. The ids are few, so mostly
        broadcast; else Spark filters the scan by a Bloom filter of them.
        """
        if self.stages is None or scope is None or not self.stages.cuts(scope):
            return side
        ids = scope.select(F.col(column).alias("_in_scope")).where("_in_scope is not null").distinct()
        return side.join(ids, F.col(key) == F.col("_in_scope"), "left_semi")

    def side(self, name: str, scope: DataFrame | None = None, column: str | None = None) -> DataFrame:
        """A frame of `SIDES`, cut by the headers in `scope`; in a run by the ids of all its headers, and stored for all of its datasets.

        What a dataset does not name of it, its joins leave out.
        """
        key, kind = SIDES[name]
        if self.stages is None or self.stages.run_ids is None:
            df = getattr(self, name)()
            return df if column is None else self.cut(df, key, scope, column)
        ids = self.stages.run_ids[kind]
        df = self.stored(f"run-{name}", lambda: self.among(getattr(Chain(self.tables, self.salts), name)(), key, ids, "run_id"))
        return df.select([c for c in df.columns if c not in self.unused])

    def among(self, side: DataFrame, key: str, ids: DataFrame, column: str) -> DataFrame:
        """Rows of a side table whose id is in a column of a stored frame."""
        # the comparison keeps every id; by it Spark knows that a Bloom filter of the ids is worth while
        found = ids.select(F.col(column).alias("_in_scope")).where("_in_scope >= ''")
        return side.join(found, F.col(key) == F.col("_in_scope"), "left_semi")

    def join(
        self,
        left: DataFrame,
        right: DataFrame,
        on: Sequence[tuple[str, str]],
        how: str = "left",
        *,
        only_if: str | None = None,
        spread: bool = False,
        spread_nulls: bool = False,
    ) -> DataFrame:
        """Join, salted where `spread` and a key is blank, or with stages, where it is heavy; AQE sees to the rest.

        `spread_nulls`: many rows have no key, as an earlier join found none.

        A left join passes on the partitioning of its left key only.  So joins
        that follow each other name the same left column wherever they can.
        """
        blank, keys = (spread, ()) if self.stages is None else (False, self.stages.heavy(on[0][0]) if spread else ())
        return skew_join(
            left, right, on, how, only_if=only_if, spread_blank=blank, spread_keys=keys, spread_nulls=spread_nulls, salts=self.salts, salt_by=SALT_COLUMNS
        )

    def in_window(self, df: DataFrame, window: DateWindow, date: str, month: str) -> DataFrame:
        """Rows dated in the window; where the table is stored by month, from its months only."""
        condition = window.contains(F.col(date))
        if month in df.columns:
            condition = condition & window.in_months(F.col(month))
        return df.where(condition)

    def _month(self, name: str) -> dict[str, str]:
        return {name: STORED_MONTH} if self.tables.by_month else {}

    # Frames used by several datasets.

    def inquiries(self) -> DataFrame:
        return self.pick(
            "sales_inquiry",
            si_so="szFSoId",
            si_po="szFPoId",
            si_customer="szCustId",
            si_do="szFDoId",
            si_dn="szFDnId",
            si_status="istatusFlag",
            si_carrier="szCarrierId",
            si_vehicle="szVehicleNo",
            si_driver="szDriverNm",
            si_eta="dtmETA",
            si_sent_wms="bSentWMS",
        )

    def orders(self) -> DataFrame:
        return self.pick(
            "sales_order",
            so_id="szFSoId",
            so_customer_po="szCustPoId",
            so_approval="gdApprovedId",
            so_customer="szCustId",
            so_payment_term="szPaymentTermId",
            so_type="szOrdertypeId",
            so_do="szFDoReffId",
            so_created="dtmCreated",
            so_ordered="dtmOrder",
            so_applied="bApplied",
            so_void="bVoid",
            **self._month("so_month"),
        )

    def orders_since(self, floor: DateFloor, scope: DataFrame | None) -> DataFrame:
        """Ids of the orders, of those in `scope` (one id column) if given, that the floor admits."""
        admitted = self.side("orders").where(floor.admits(F.col("so_ordered"))).select("so_id")
        if scope is None:
            return admitted
        return self.join(admitted, scope, [("so_id", scope.columns[0])], "left_semi")

    def order_items(self, scope: DataFrame | None = None) -> DataFrame:
        """Items of all orders, or of those in `scope` (one id column).

        A plan is about one month, the items are of all years: the ids of the
        month keep the others out of the shuffle when they can be broadcast or
        put into a Bloom filter, and out of the wide join in any case.
        """
        if self.stages is not None and self.stages.run_ids is not None:
            return self.side("order_lines").drop("soi_line", "soi_reference")
        df = self.order_lines().drop("soi_line", "soi_reference")
        if scope is None:
            return df
        return self.join(df, scope, [("soi_so", scope.columns[0])], "left_semi")

    def order_lines(self) -> DataFrame:
        """Items with what the discounts need of them."""
        return self.pick(
            "sales_order_item",
            soi_so="szFSoId",
            soi_line="shItemNumber",
            soi_product="szProductId",
            soi_type="szOrderItemTypeId",
            soi_parent="szParentId",
            soi_payment="szPaymentType",
            soi_qty="decQty",
            soi_units="decUomQty",
            soi_amount="decAmount",
            soi_net="decDPP",
            soi_tax="decTax",
            soi_price="decPrice",
            soi_taxable="bTaxable",
            soi_reference="szPrincipalDiscRefId",
        )

    def purchase_orders(self) -> DataFrame:
        return self.pick(
            "purchase_order",
            po_id="szFPo_sId",
            po_status="szStatus",
            po_created="dtmCreated",
            po_date="dtmPO",
            po_void="bVoid",
            **self._month("po_month"),
        )

    def purchase_items(self) -> DataFrame:
        return self.pick(
            "purchase_order_item",
            poi_po="szFPo_sId",
            poi_product="szProductId",
            poi_type="purchaseItemTypeId",
            poi_qty="decQty",
            poi_tax="decPPN",
            poi_net="decDPP",
            poi_amount="decAmount",
            poi_discount="decDiscount",
            poi_price="decPrice",
            poi_taxable="bTaxable",
        )

    def receipts(self) -> DataFrame:
        return self.pick(
            "goods_receipt",
            receipt_id="szFPoReceipt_sId",
            receipt_po="szPoId",
            receipt_created="dtmCreated",
            receipt_date="dtmReceipt",
        )

    def customers(self) -> DataFrame:
        """Customers with their category, if any."""
        customers = self.pick(
            "customer", cust_id="szCustId", cust_name="szName", cust_category="szCategory_2"
        )
        categories = self.pick(
            "category", category_id="szCategoryId", category_name="szDescription"
        )
        return self.join(customers, categories, [("cust_category", "category_id")])

    def products(self) -> DataFrame:
        return self.pick("product", product_id="szProductId", product_name="szName")

    def confirmations(self) -> DataFrame:
        """Delivery confirmations that name an order."""
        df = self.pick(
            "delivery_confirmation",
            delv_so="custOrderNo",
            delv_no="orderNo",
            delv_do="szDoBosnetId",
            delv_out="outTime",
        )
        return df.where(F.rtrim("delv_so") != "")

    def delivered(self, scope: DataFrame | None = None) -> DataFrame:
        """Delivered quantities; `scope` restricts them to orders, or to `(order, delivery)` pairs."""
        if scope is not None and len(scope.columns) == 1 and self.stages is not None and self.stages.run_orders is not None:
            whole = Chain(self.tables, self.salts)
            items = whole.delivered_items() if self.stages.run_ids is None else self.side("delivered_items")
            scope = self.stages.run_orders if self.stages.run_ids is None else None
            return self.stored(self.stages.name("delivered", self.stages.window), lambda: whole._delivered(items, scope))
        return self._delivered(self.delivered_items(), scope)

    def delivered_items(self) -> DataFrame:
        return self.pick(
            "delivery_confirmation_item",
            custOrderNo="custOrderNo",
            orderNo="orderNo",
            code="code",
            qty="qty",
        )

    def _delivered(self, items: DataFrame, scope: DataFrame | None) -> DataFrame:
        if scope is not None:
            on = list(zip(("custOrderNo", "orderNo"), scope.columns))
            items = self.join(items, scope, on, "left_semi")
        return rollups.delivered_quantity(items).select(
            F.col("custOrderNo").alias("dlv_so"),
            F.col("orderNo").alias("dlv_no"),
            F.col("code").alias("dlv_product"),
            F.col("qty").alias("dlv_qty"),
        )

    def transfers(self) -> DataFrame:
        df = self.pick(
            "transfer_log",
            transfer_so="szDocId",
            transfer_flag="bAlreadyTransferred",
            transfer_time="dtmTransferred",
        )
        return df.where("transfer_flag").drop("transfer_flag")

    def cancels(self) -> DataFrame:
        return self.pick("cancel_log", cancel_so="szDocId", canceled="bAlreadyTransferred", cancel_data="szData")

    def inquiry_orders(self) -> DataFrame:
        """Sales-order ids that inquiries name."""
        return self.pick("sales_inquiry", si_so="szFSoId")

    def rejections(self) -> DataFrame:
        return self.pick("approval", rejected_id="gdApprovedId", rejected="bRejected")

    def approval_items(self) -> DataFrame:
        return self.pick("approval_item", gd_id="gdApprovedId", gd_level="btApprovedLevel", gd_time="dtmApproved", gd_approved="bApproved")

    def deliveries(self) -> DataFrame:
        return self.pick(
            "delivery_order",
            do_id="szDoId",
            do_invoice="szFInvoiceId",
            do_carrier="szCarrierId",
            do_vehicle="szVehicleNumber",
            do_driver="szDriverName",
            do_created="dtmCreated",
            do_delivery="dtmDelivery",
        )

    def invoices(self) -> DataFrame:
        return self.pick("invoice", invoice_id="szFInvoiceId", invoice_created="dtmCreated")

    def invoice_items(self) -> DataFrame:
        return self.pick(
            "invoice_item",
            item_invoice="szFInvoiceId",
            item_product="szProductId",
            item_type="szOrderItemTypeId",
            item_qty="decQty",
        )

    def delivery_notes(self) -> DataFrame:
        return self.pick("delivery_note", dn_id="szFDNId", dn_updated="dtmLastUpdated")

    def delivery_note_items(self) -> DataFrame:
        return self.pick(
            "delivery_note_item", dni_dn="szFDNId", dni_product="szProductId", dni_qty="decQty"
        )

    def note_status(self, scope: DataFrame | None = None) -> DataFrame:
        """Per delivery note, the flag of its latest closing; with stages, of the notes in `scope` (`si_dn`), in a run of all its notes."""
        if self.stages is not None and self.stages.run_ids is not None:
            return self.stored("run-note-status", lambda: self._note_status(self.side("closing_items")))
        return self._note_status(self.side("closing_items", scope, "si_dn"))

    def _note_status(self, items: DataFrame) -> DataFrame:
        closings = self.pick(
            "note_closing", cl_id="szCloseDNId", cl_applied="bApplied", cl_updated="dtmLastUpdated"
        )
        closed = self.join(items, closings, [("cli_id", "cl_id")], "inner")
        # Latest first, undated last, then by id; an aggregate, so that each task sends one row per note.
        age = "-timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', cl_updated)"
        order = F.struct(F.col("cl_updated").isNull(), F.expr(age), "cl_id", "cl_applied")
        return closed.groupBy("closed_dn").agg(F.min_by("cl_applied", order).alias("cl_applied"))

    def closing_items(self) -> DataFrame:
        return self.pick("note_closing_item", cli_id="szCloseDNId", closed_dn="szDNId")

    def bonus_source(self) -> DataFrame:
        return self.pick(
            "bonus_source",
            szFSoId="szFSoId",
            shItemNumber="shItemNumber",
            szProductId="szProductId",
            szParentId="szParentId",
            szPaymentType="szPaymentType",
            szOrderItemTypeId="szOrderItemTypeId",
            decBonusAmount="decBonusAmount",
        )

    def bonuses(self, orders: DataFrame | None = None) -> DataFrame:
        """Discount roll-up, for the ids in `orders` (one column) if given."""
        if orders is not None and self.stages is not None and self.stages.run_orders is not None:
            return self._shared_bonuses(orders.toDF("bonus_order"))
        totals = self._rollup(None if orders is None else orders.toDF("szFSoId"))
        names = dict(zip(rollups.BONUS_KEYS, BONUS_COLUMNS))
        return totals.select([F.col(c).alias(names.get(c, c)) for c in totals.columns])

    def _shared_bonuses(self, orders: DataFrame) -> DataFrame:
        """The roll-up of all orders of the run, computed once; an order listed twice counts twice."""

        def build() -> DataFrame:
            totals = self._rollup(self.stages.run_orders.toDF("szFSoId"))
            names = dict(zip(rollups.BONUS_KEYS, BONUS_COLUMNS))
            return totals.select([F.col(c).alias(names.get(c, c)) for c in totals.columns])

        totals = self.stored(self.stages.name("bonuses", self.stages.window), build)
        weights = orders.groupBy("bonus_order").agg(F.count(F.lit(1)).alias("_weight"))
        weighted = self.join(totals, weights, [("bonus_so", "bonus_order")], "inner")
        return weighted.select(*BONUS_COLUMNS, *[(F.col(c) * F.col("_weight")).alias(c) for c in rollups.DISCOUNT_NAMES])

    def _rollup(self, orders: DataFrame | None) -> DataFrame:
        in_run = self.stages is not None and self.stages.run_ids is not None
        lines = Chain(self.tables, self.salts, stages=self.stages).side("order_lines")
        items = lines.selectExpr(
            "soi_so as szFSoId",
            "soi_line as shItemNumber",
            "soi_reference as szPrincipalDiscRefId",
            "soi_taxable as bTaxable",
            "soi_net as decDPP",
            "soi_tax as decTax",
        )
        source = self.side("bonus_source")
        return rollups.bonus_rollup(
            items,
            source,
            orders,
            salts=self.salts,
            heavy=None if self.stages is None or self.tables.bucketed and not in_run else self.stages.heavy("si_so"),
        )

    def join_bonuses(self, df: DataFrame, bonuses: DataFrame, order_key: str) -> DataFrame:
        """Discounts of a row's item; `order_key` is the left column its item was joined on."""
        keys = (order_key, "soi_product", "soi_parent", "soi_payment", "soi_type")
        return self.join(df, bonuses, list(zip(keys, BONUS_COLUMNS)))


BONUS_COLUMNS = ("bonus_so", "bonus_product", "bonus_parent", "bonus_payment", "bonus_type")
