"""SQL counterparts of the registered queries, over the bridge views.

The datasets are written here the plain way: every document joined to every
other in one chain, all pairs of sales and purchase items, then DISTINCT.
"""

from __future__ import annotations

from .bridge import skewed_views, with_bridge
from .money import grid_sql as g

NONE = "timestamp '1900-01-01'"

LATEST_HISTORY = """
    select szDoId as new_do, szDoIdOld as old_do from erp_delivery_history
    order by dtmLastUpdated desc nulls last, szDoIdOld, szDoId limit 1"""

NOTE_STATUS = """
    select szDNId as dn, bApplied as closed
    from (select x.szDNId, h.bApplied, row_number() over (
            partition by x.szDNId
            order by h.dtmLastUpdated desc nulls last, h.szCloseDNId, h.bApplied) as place
          from erp_note_closing_item x join erp_note_closing h on h.szCloseDNId = x.szCloseDNId)
    where place = 1"""

MAX_LEVEL = "select gdApprovedId as gd, max(btApprovedLevel) as level from erp_approval_item group by 1"

DELIVERED = """
    select custOrderNo, orderNo, code, sum(qty) as qty
    from erp_delivery_confirmation_item group by custOrderNo, orderNo, code"""


def _bonus(floor: str | None) -> str:
    """Discounts by five keys: one term per pair of item and bonus on a line."""

    def term(reference: str, part: str, untaxed: str) -> str:
        return f"""sum(case when i.szPrincipalDiscRefId = '{reference}' then
            case when i.bTaxable and i.decDPP + i.decTax <> 0
              then s.decBonusAmount * i.{part} / (i.decDPP + i.decTax) else {untaxed} end else 0 end)"""

    full = "s.decBonusAmount"
    since = "" if floor is None else f"join erp_sales_order f on f.szFSoId = i.szFSoId and f.dtmOrder {floor}"
    return f"""
    select i.szFSoId, s.szProductId, s.szParentId, s.szPaymentType, s.szOrderItemTypeId,
      {term('Invoice Disc. Item', 'decDPP', full)} as decDisc1DPP,
      {term('Invoice Disc. Item', 'decTax', '0')} as decDisc1Tax,
      {term('Invoice Disc. Item 2', 'decDPP', full)} as decDisc2DPP,
      {term('Invoice Disc. Item 2', 'decTax', full)} as decDisc2Tax,
      {term('Invoice Disc.', 'decDPP', full)} as decDiscFakturDPP,
      {term('Invoice Disc.', 'decTax', full)} as decDiscFakturTax
    from erp_sales_order_item i
    join erp_bonus_source s on s.szFSoId = i.szFSoId and s.shItemNumber = i.shItemNumber
    {since}
    where s.szProductId is not null
    group by i.szFSoId, s.szProductId, s.szParentId, s.szPaymentType, s.szOrderItemTypeId"""


DISCOUNTS = (
    "decDisc1DPP", "decDisc1Tax", "decDisc2DPP", "decDisc2Tax", "decDiscFakturDPP", "decDiscFakturTax"
)
BONUS_ON = (
    "b.szFSoId = soi.szFSoId and b.szProductId = soi.szProductId and b.szParentId = soi.szParentId"
    " and b.szPaymentType = soi.szPaymentType and b.szOrderItemTypeId = soi.szOrderItemTypeId"
)

NO_SO = "trim(coalesce(si.szFSoId, '')) = ''"
ORDER_NUMBER = (
    "case when coalesce(trim(so.szCustPoId), '') = '' then si.szFPoId else trim(so.szCustPoId) end"
)
WANTED = "(soi.szOrderItemTypeId = 'JUAL' or poi.purchaseItemTypeId in ('BELI', 'BELI-BERIKAT'))"


def _dates(start: str, end: str, closed: bool = False) -> str:
    upper = "<=" if closed else "<"

    def inside(column: str) -> str:
        return f"{column} >= timestamp '{start}' and {column} {upper} timestamp '{end}'"

    return (
        f"((rtrim(si.szFPoId) <> '' and {inside('po.dtmPO')})"
        f" or (rtrim(si.szFPoId) = '' and {inside('so.dtmOrder')}))"
    )


# Inquiry to items, customer, receipt, delivery, confirmation, transfer and note.
CHAIN = """
    from erp_sales_inquiry si
    left join erp_sales_order so on so.szFSoId = si.szFSoId
    left join erp_purchase_order po on po.szFPo_sId = si.szFPoId
    left join erp_sales_order_item soi on soi.szFSoId = so.szFSoId
    left join erp_purchase_order_item poi on poi.szFPo_sId = po.szFPo_sId
    left join erp_product bought on bought.szProductId = poi.szProductId
    left join erp_product sold on sold.szProductId = soi.szProductId
    left join erp_customer cu on cu.szCustId = si.szCustId
    left join erp_category cat on cat.szCategoryId = cu.szCategory_2
    left join erp_goods_receipt gr on gr.szPoId = po.szFPo_sId and rtrim(gr.szPoId) <> ''
    left join erp_delivery_order dord on dord.szDoId = si.szFDoId
    left join erp_delivery_confirmation dc
      on dc.custOrderNo = si.szFSoId and rtrim(dc.custOrderNo) <> '' and dc.szDoBosnetId = dord.szDoId
    left join erp_transfer_log tl on tl.szDocId = si.szFSoId and tl.bAlreadyTransferred
    left join erp_delivery_note dn on dn.szFDNId = si.szFDnId
    left join note_status ns on ns.dn = si.szFDnId
    left join bonus b on """ + BONUS_ON

EXCLUSIONS = """
    left join erp_cancel_log cl on cl.szDocId = si.szFSoId
    left join erp_approval ap on ap.gdApprovedId = so.gdApprovedId"""

KEPT = "not coalesce(cl.bAlreadyTransferred, false) and not coalesce(ap.bRejected, false)"


def _po_columns(own: str) -> str:
    return f"""
      {ORDER_NUMBER} as purchase_order_number,
      coalesce(po.dtmCreated, {NONE}) as date_created,
      coalesce(so.dtmCreated, {NONE}) as po_on_review_date,
      coalesce(so.dtmOrder, {NONE}) as po_approve_lv1_date,
      si.szFSoId as sales_order_number,
      cl.bAlreadyTransferred as canceled_order,
      ap.bRejected as rejected_order,
      coalesce(tl.dtmTransferred, {NONE}) as send_to_wms_date,
      si.szCustId as customer_id,
      cu.szName as customer_name,
      coalesce(cat.szDescription, '') as customer_category_description,
      coalesce(dc.outTime, {NONE}) as delivered_date_feedback_wms,
      coalesce(gr.dtmReceipt, {NONE}) as received_date,
      case when rtrim(si.szFPoId) = '' then so.dtmCreated else po.dtmCreated end as "poDate",
      case when {NO_SO} then poi.szProductId else soi.szProductId end as product_id,
      case when {NO_SO} then bought.szName else sold.szName end as product_name,
      {own},
      case when {NO_SO} then poi.decAmount else soi.decAmount end as amount_incl_ppn_before_discount,
      case when {NO_SO} then poi.decAmount else soi.decAmount end
        - coalesce(b.decDiscFakturDPP, 0) - coalesce(b.decDiscFakturTax, 0) as nett_amount_incl_ppn,
      coalesce(ns.closed, false) as "bStatusDN",
      coalesce(dn.dtmLastUpdated, {NONE}) as dn_closed_date,
      si.szFDnId as szfdnid"""


def _gridded(ctes: dict[str, str], last: str, *money: str) -> str:
    replaced = ", ".join(f'{g(m)} as "{m}"' for m in money)
    text = ", ".join(f"{name} as ({sql})" for name, sql in ctes.items())
    return f"with {text}, result as ({last}) select * replace ({replaced}) from result"


def po_tracking_month_sql(start: str, end: str) -> str:
    quantity = f"case when {NO_SO} then poi.decQty else soi.decQty end as qty_order"
    return _gridded(
        {"bonus": _bonus(f">= timestamp '{start}'"), "note_status": NOTE_STATUS},
        f"""select distinct {_po_columns(quantity)} {CHAIN} {EXCLUSIONS}
        where {WANTED} and {_dates(start, end)}
          and so.dtmCreated >= timestamp '{start}' and so.dtmCreated < timestamp '{end}'
          and cat.szDescription in ('GT', 'MTI') and {KEPT}
          and so.szCustPoId not like '%RES0%' and so.szCustPoId not like '%RES1%'
          and so.szCustPoId not like '%RES2%'""",
        "amount_incl_ppn_before_discount",
        "nett_amount_incl_ppn",
    )


def po_tracking_by_delivery_sql(start: str, end: str, out_start: str, out_end: str) -> str:
    own = """coalesce(dq.qty, 0) as qty_delivered,
      case when coalesce(trim(dn.szFDNId), '') = '' then 0 else coalesce(dni.decQty, 0) end as close_dn_qty"""
    product = f"case when {NO_SO} then poi.szProductId else soi.szProductId end"
    key = f"coalesce({ORDER_NUMBER}, '') || '-' || coalesce({product}, '')"
    return _gridded(
        {
            "bonus": _bonus(f">= timestamp '{out_start}'"),
            "note_status": NOTE_STATUS,
            "delivered": DELIVERED,
        },
        f"""select distinct {_po_columns(own)}, {key} as "InvoiceProductID" {CHAIN}
        left join delivered dq
          on dq.custOrderNo = dc.custOrderNo and dq.orderNo = dc.orderNo and dq.code = soi.szProductId
        left join erp_delivery_note_item dni on dni.szFDNId = dn.szFDNId and dni.szProductId = soi.szProductId
        {EXCLUSIONS}
        where {WANTED} and {_dates(start, end)}
          and dc.outTime >= timestamp '{out_start}' and dc.outTime < timestamp '{out_end}'
          and cat.szDescription in ('GT', 'MTI') and {KEPT}""",
        "amount_incl_ppn_before_discount",
        "nett_amount_incl_ppn",
    )


def _pick_side(name: str, purchase: str, sales: str) -> str:
    return f'case when {NO_SO} then {purchase} else {sales} end as "{name}"'


def _share(amount: str, part: str, taxable: str, net: str, tax: str, otherwise: str) -> str:
    return (
        f"case when {taxable} and ({net} + {tax}) <> 0"
        f" then {amount} * {part} / ({net} + {tax}) else {otherwise} end"
    )


def _poi_share(amount: str, part: str, otherwise: str) -> str:
    return _share(amount, part, "poi.bTaxable", "poi.decDPP", "poi.decPPN", otherwise)


SOI_PRICE = _share("soi.decPrice", "soi.decDPP", "soi.bTaxable", "soi.decDPP", "soi.decTax", "soi.decPrice")

APPROVALS = """
    left join erp_approval_item a1 on a1.gdApprovedId = so.gdApprovedId and a1.btApprovedLevel = 1
    left join erp_approval_item a2 on a2.gdApprovedId = so.gdApprovedId and a2.btApprovedLevel = 2
    left join erp_approval_item a3 on a3.gdApprovedId = so.gdApprovedId and a3.btApprovedLevel = 3
    left join levels ml on ml.gd = so.gdApprovedId"""

APPROVAL_COLUMNS = ", ".join(
    f'coalesce(a{n}.dtmApproved, {NONE}) as "dtmApproved{n}", a{n}.bApproved as "bApproved{n}"'
    for n in (1, 2, 3)
)

NEXT_LEVEL = "cast(coalesce(ml.level, 0) + 1 as varchar)"


def so_tracking_inquiry_sql(start: str, end: str) -> str:
    discounts = [
        _pick_side("decDisc1DPP", _poi_share("poi.decDiscount", "poi.decDPP", "poi.decDiscount"), "b.decDisc1DPP"),
        _pick_side("decDisc1Tax", _poi_share("poi.decDiscount", "poi.decPPN", "0"), "b.decDisc1Tax"),
        *[_pick_side(name, "0", f"b.{name}") for name in DISCOUNTS[2:]],
    ]
    has_new = "coalesce(rtrim(inew.szFInvoiceId), '') <> ''"
    columns = ",\n".join([
        f'{ORDER_NUMBER} as "szFPOid"',
        'so.gdApprovedId as "gdApprovedId"',
        """coalesce(po.szStatus, '') as "statusPO" """,
        'si.szCustId as "szCustId"',
        'coalesce(si.istatusFlag, 0) as "IstatusFlag"',
        'si.szFSoId as "szFSoId"',
        f'coalesce(po.dtmCreated, {NONE}) as "dtmCreatedPO"',
        'si.szFDoId as "szFDoId"',
        f'coalesce(so.dtmCreated, {NONE}) as "dtmCreatedSO"',
        'si.szFDnId as "szFDnId"',
        f'coalesce(dc.outTime, {NONE}) as "dtmCreatedDO"',
        'si.bSentWMS as "bSentWMS"',
        f'coalesce(gr.dtmCreated, {NONE}) as "dtmCreatedGR"',
        f'coalesce(gr.dtmReceipt, {NONE}) as "dtmReceiptPOrec"',
        'si.szCarrierId as "szCarrierId"',
        f'coalesce(dord.dtmDelivery, {NONE}) as "dtmDelivery"',
        f'coalesce(inv.dtmCreated, {NONE}) as "dtmCreatedInv"',
        f'coalesce(tl.dtmTransferred, {NONE}) as "dtmSendWMS"',
        'cu.szName as "custNm"',
        f'coalesce(so.dtmOrder, {NONE}) as "dtmOrder"',
        'si.szVehicleNo as "szVehicleNo"',
        'si.szDriverNm as "szDriverNm"',
        'coalesce(po.bVoid, false) as "bvoidPO"',
        'so.szPaymentTermId as "szPaymentTermId"',
        """case when rtrim(si.szFPoId) = '' then so.dtmCreated else po.dtmCreated end as "poDate" """,
        """case when rtrim(si.szFPoId) = '' then so.dtmOrder else po.dtmPO end as "podatefilter" """,
        """coalesce(gr.szFPoReceipt_sId, '') as "szFPoReceipt_sId" """,
        f'coalesce(gr.dtmReceipt, {NONE}) as "dtmreceipt"',
        _pick_side("szProductId", "poi.szProductId", "soi.szProductId"),
        _pick_side("decQty", "poi.decQty", "soi.decQty"),
        _pick_side("decPPN", "poi.decPPN", "soi.decTax"),
        _pick_side("decDPP", "poi.decDPP", "soi.decDPP"),
        _pick_side("decAmountPOSO", "poi.decAmount", "soi.decAmount"),
        *discounts,
        _pick_side("decPrice", _poi_share("poi.decPrice", "poi.decDPP", "poi.decPrice"), SOI_PRICE),
        _pick_side("prodNm", "bought.szName", "sold.szName"),
        """case when coalesce(trim(dn.szFDNId), '') = '' then 0 else coalesce(dni.decQty, 0) end
             as "decQtyReceipt" """,
        """coalesce(dc.custOrderNo, '') as feedback""",
        'coalesce(dq.qty, 0) as "decQtyDelivered"',
        'coalesce(ns.closed, false) as "bStatusDN"',
        f'case when {has_new} then inew.szFInvoiceId else inv.szFInvoiceId end as "szFInvoiceId"',
        f"""case when {has_new} then coalesce(iinew.decQty, 0) else coalesce(ii.decQty, 0) end
             as "decQtyInvoice" """,
        """coalesce(cu.szCategory_2, '') as "szCustCat2" """,
        """coalesce(cat.szDescription, '') as "szCustCat2Desc" """,
        'si.dtmETA as "dtmETA"',
        """coalesce(cd.szData, '') as "szDataCancelPO" """,
        f"""case when so.bApplied or so.bVoid then '' else {NEXT_LEVEL} end as "currentApprovalLevel" """,
        'so.bVoid as "bVoid"',
        APPROVAL_COLUMNS,
        f'coalesce(dn.dtmLastUpdated, {NONE}) as "MaxLastUpdated"',
    ])
    return _gridded(
        {
            "bonus": _bonus(f"> timestamp '{start}'"),
            "note_status": NOTE_STATUS,
            "delivered": DELIVERED,
            "levels": MAX_LEVEL,
            "latest_history": LATEST_HISTORY,
        },
        f"""select distinct {columns} {CHAIN}
        left join delivered dq
          on dq.custOrderNo = dc.custOrderNo and dq.orderNo = dc.orderNo and dq.code = soi.szProductId
        left join erp_delivery_note_item dni on dni.szFDNId = dn.szFDNId and dni.szProductId = soi.szProductId
        left join erp_invoice inv on inv.szFInvoiceId = dord.szFInvoiceId
        left join erp_invoice_item ii on ii.szFInvoiceId = inv.szFInvoiceId
          and ii.szProductId = soi.szProductId and ii.szOrderItemTypeId = soi.szOrderItemTypeId
        left join erp_cancel_log cd on cd.szDocId = si.szFSoId and cd.bAlreadyTransferred
        left join latest_history lh on lh.old_do = dord.szDoId
        left join erp_delivery_order dnew on dnew.szDoId = lh.new_do
        left join erp_invoice inew on inew.szFInvoiceId = dnew.szFInvoiceId
        left join erp_invoice_item iinew
          on iinew.szFInvoiceId = inew.szFInvoiceId and iinew.szProductId = soi.szProductId
        {APPROVALS}
        where {WANTED} and {_dates(start, end, closed=True)}""",
        "decAmountPOSO", "decPPN", "decDPP", "decPrice", *DISCOUNTS,
    )


def so_tracking_no_inquiry_sql(start: str, end: str) -> str:
    discounts = ", ".join(f'b.{name} as "{name}"' for name in DISCOUNTS)
    return _gridded(
        {"bonus": _bonus(None), "levels": MAX_LEVEL},
        f"""select distinct
          coalesce(trim(so.szCustPoId), '') as "szFPOid", so.gdApprovedId as "gdApprovedId",
          so.szOrdertypeId as "szOrdertypeId", so.szCustId as "szCustId", so.szFSoId as "szFSoId",
          dord.szDoId as "szDoId", dord.szCarrierId as "szCarrierId", cu.szName as "custNm",
          coalesce(so.dtmCreated, make_date(1900, 1, 1)) as "dtmOrder",
          dord.szVehicleNumber as "szVehicleNumber", coalesce(dord.dtmCreated, {NONE}) as "dtmCreatedDO",
          dord.szDriverName as "szDriverName", coalesce(so.dtmCreated, {NONE}) as "dtmCreatedSO",
          coalesce(inv.dtmCreated, {NONE}) as "dtmCreatedInv", so.szPaymentTermId as "szPaymentTermId",
          coalesce(dord.dtmDelivery, {NONE}) as "dtmDelivery", soi.szProductId as "szProductId",
          case when soi.decQty = 0 then soi.decUomQty else soi.decQty end as "decQty",
          soi.decTax as "decPPN", soi.decDPP as "decDPP",
          case when so.bApplied or so.bVoid then ''
               when not so.bApplied and not so.bVoid then '1' else {NEXT_LEVEL} end as "currentApprovalLevel",
          {SOI_PRICE} as "decPrice", {APPROVAL_COLUMNS}, {discounts}, sold.szName as "prodNm",
          coalesce(cu.szCategory_2, '') as "szCustCat2", coalesce(cat.szDescription, '') as "szCustCat2Desc",
          so.bVoid as "bVoid"
        from erp_sales_order so
        left join erp_sales_order_item soi on soi.szFSoId = so.szFSoId and rtrim(soi.szProductId) <> ''
        left join erp_product sold on sold.szProductId = soi.szProductId
        left join erp_customer cu on cu.szCustId = so.szCustId
        left join erp_category cat on cat.szCategoryId = cu.szCategory_2
        left join erp_delivery_order dord on dord.szDoId = so.szFDoReffId
        left join erp_invoice inv on inv.szFInvoiceId = dord.szFInvoiceId
        left join bonus b on {BONUS_ON}
        {APPROVALS}
        where so.szFSoId not in (select szFSoId from erp_sales_inquiry)
          and so.dtmOrder >= timestamp '{start}' and so.dtmOrder < timestamp '{end}'""",
        "decPPN", "decDPP", "decPrice", *DISCOUNTS,
    )


HALF = ("1998-01-01", "1998-07-01")
QUARTER = ("1998-04-01", "1998-07-01")
ALL = ("1990-01-01", "2010-01-01")

LINKED = """
    from erp_sales_inquiry si
    left join erp_sales_order so on so.szFSoId = si.szFSoId
    left join erp_purchase_order po on po.szFPo_sId = si.szFPoId"""


def _history_sql(latest: str) -> str:
    return f"""
    with latest as ({latest})
    select distinct dord.szDoId as do_id, ii.szProductId as soi_product,
      case when coalesce(rtrim(inew.szFInvoiceId), '') = '' then inv.szFInvoiceId else inew.szFInvoiceId end
        as "szFInvoiceId",
      case when coalesce(rtrim(inew.szFInvoiceId), '') = '' then coalesce(ii.decQty, 0)
        else coalesce(iinew.decQty, 0) end as "decQtyInvoice"
    from erp_delivery_order dord
    left join erp_invoice inv on inv.szFInvoiceId = dord.szFInvoiceId
    left join erp_invoice_item ii on ii.szFInvoiceId = inv.szFInvoiceId
    left join latest lh on lh.old_do = dord.szDoId
    left join erp_delivery_order dnew on dnew.szDoId = lh.new_do
    left join erp_invoice inew on inew.szFInvoiceId = dnew.szFInvoiceId
    left join erp_invoice_item iinew
      on iinew.szFInvoiceId = inew.szFInvoiceId and iinew.szProductId = ii.szProductId"""


HISTORY_PER_DELIVERY = """
    select new_do, old_do from (
      select szDoId as new_do, szDoIdOld as old_do, row_number() over (
        partition by szDoIdOld order by dtmLastUpdated desc nulls last, szDoId) as place
      from erp_delivery_history) where place = 1"""

BONUS_COLUMNS = 'b.szFSoId as "szFSoId", b.szProductId as "szProductId", b.szParentId as "szParentId",' \
    ' b.szPaymentType as "szPaymentType", b.szOrderItemTypeId as "szOrderItemTypeId", ' + ", ".join(
        f'{g("b." + name)} as "{name}"' for name in DISCOUNTS
    )

def _as_source(column: str) -> str:
    """A date as text in the one form that the whole column asks for."""
    some = lambda test: f"(select bool_or({test}) from made)"
    return f"""coalesce(case
      when {some(f'microsecond({column}) % 1000 <> 0')} then strftime({column}, '%Y-%m-%d %H:%M:%S.%f')
      when {some(f'microsecond({column}) % 1000000 <> 0')} then strftime({column}, '%Y-%m-%d %H:%M:%S.%g')
      when {some(f"{column} <> date_trunc('day', {column})")} then strftime({column}, '%Y-%m-%d %H:%M:%S')
      else strftime({column}, '%Y-%m-%d') end, 'NaT') as {column}"""


_ORACLE: dict[str, str] = {
    "po_tracking_mtd": po_tracking_month_sql(*HALF),
    "po_tracking_mtd_all_dates": po_tracking_month_sql(*ALL),
    "po_tracking_3m": po_tracking_by_delivery_sql(*HALF, *QUARTER),
    "po_tracking_3m_all_dates": po_tracking_by_delivery_sql(*ALL, *ALL),
    "so_tracking_inquiry": so_tracking_inquiry_sql(*HALF),
    "so_tracking_inquiry_all_dates": so_tracking_inquiry_sql(*ALL),
    "so_tracking_no_inquiry": so_tracking_no_inquiry_sql(*HALF),
    "so_tracking_no_inquiry_all_dates": so_tracking_no_inquiry_sql(*ALL),
    "null_defaults": f"""
        select si.szFSoId as si_so, si.szFPoId as si_po, si.szFDoId as si_do,
          coalesce(po.szStatus, '') as status, coalesce(si.istatusFlag, 0) as status_flag,
          coalesce(po.dtmCreated, {NONE}) as po_created,
          coalesce(so.dtmCreated, make_date(1900, 1, 1)) as so_created,
          coalesce(po.bVoid, false) as po_void,
          coalesce(dc.custOrderNo, '') as feedback, coalesce(dc.outTime, {NONE}) as delivered
        {LINKED}
        left join erp_delivery_confirmation dc
          on dc.custOrderNo = si.szFSoId and dc.custOrderNo <> '' and dc.szDoBosnetId = si.szFDoId""",
    "blank_fallback": f"""
        select si.szFSoId as si_so, si.szFPoId as si_po,
          coalesce(trim(so.szCustPoId), '') = '' as is_blank,
          {ORDER_NUMBER} as order_number, coalesce(trim(so.szCustPoId), '') as customer_po
        from erp_sales_inquiry si left join erp_sales_order so on so.szFSoId = si.szFSoId""",
    "source_switch": f"""
        with bonus as ({_bonus(None)}), result as (
          select distinct si.szFSoId as si_so, si.szFPoId as si_po,
            case when si.szFPoId = '' then so.dtmCreated else po.dtmCreated end as order_date,
            case when si.szFPoId = '' then so.dtmOrder else po.dtmPO end as filter_date,
            {_pick_side("product", "poi.szProductId", "soi.szProductId")},
            {_pick_side("qty", "poi.decQty", "soi.decQty")},
            {_pick_side("tax", "poi.decPPN", "soi.decTax")},
            {_pick_side("net", "poi.decDPP", "soi.decDPP")},
            {_pick_side("amount", "poi.decAmount", "soi.decAmount")},
            {", ".join(_pick_side(n, "0", f"b.{n}") for n in DISCOUNTS[2:])}
          {LINKED}
          left join erp_sales_order_item soi on soi.szFSoId = so.szFSoId
          left join erp_purchase_order_item poi on poi.szFPo_sId = po.szFPo_sId
          left join bonus b on {BONUS_ON})
        select * replace ({", ".join(f'{g(n)} as "{n}"' for n in ("tax", "net", "amount", *DISCOUNTS[2:]))})
        from result""",
    "tax_split": f"""
        select poi.szFPo_sId as "szFPo_sId", poi.szProductId as "szProductId", poi.decQty as "decQty",
          {g(_poi_share("poi.decDiscount", "poi.decDPP", "poi.decDiscount"))} as discount_net,
          {g(_poi_share("poi.decDiscount", "poi.decPPN", "0"))} as discount_tax
        from erp_purchase_order_item poi""",
    "net_price": f"""
        select soi.szFSoId as document, soi.szProductId as "szProductId", {g(SOI_PRICE)} as net_price
        from erp_sales_order_item soi
        union all
        select poi.szFPo_sId, poi.szProductId, {g(_poi_share("poi.decPrice", "poi.decDPP", "poi.decPrice"))}
        from erp_purchase_order_item poi""",
    "net_amount": f"""
        with bonus as ({_bonus(None)})
        select soi.szFSoId as soi_so, soi.szProductId as soi_product,
          {g("soi.decAmount - coalesce(b.decDiscFakturDPP, 0) - coalesce(b.decDiscFakturTax, 0)")} as net_amount
        from erp_sales_order_item soi left join bonus b on {BONUS_ON}""",
    "conditional_qty": """
        select si.szFSoId as si_so, si.szFDnId as si_dn, dni.szProductId as dni_product,
          case when coalesce(trim(dn.szFDNId), '') = '' then 0 else coalesce(dni.decQty, 0) end as noted_qty
        from erp_sales_inquiry si
        left join erp_delivery_note dn on dn.szFDNId = si.szFDnId
        left join erp_delivery_note_item dni on dni.szFDNId = dn.szFDNId""",
    "unit_fallback_qty": """
        select szFSoId as "szFSoId", szProductId as "szProductId",
          case when decQty = 0 then decUomQty else decQty end as qty
        from erp_sales_order_item""",
    "history_fallback": _history_sql(HISTORY_PER_DELIVERY),
    "history_fallback_global": _history_sql(LATEST_HISTORY),
    "approval_level": f"""
        with levels as ({MAX_LEVEL})
        select so.szFSoId as "szFSoId",
          case when so.bApplied or so.bVoid then '' else {NEXT_LEVEL} end as level
        from erp_sales_order so left join levels ml on ml.gd = so.gdApprovedId""",
    "approval_level_mt": f"""
        with levels as ({MAX_LEVEL})
        select so.szFSoId as "szFSoId",
          case when so.bApplied or so.bVoid then ''
               when not so.bApplied and not so.bVoid then '1' else {NEXT_LEVEL} end as level
        from erp_sales_order so left join levels ml on ml.gd = so.gdApprovedId""",
    "concat_key": f"""
        select si.szFSoId as si_so,
          coalesce({ORDER_NUMBER}, '') || '-' || coalesce(soi.szProductId, '') as line_key,
          coalesce(so.szCustPoId, '') || '-' || coalesce(so.szPaymentTermId, '') as term_key
        from erp_sales_inquiry si
        left join erp_sales_order so on so.szFSoId = si.szFSoId
        left join erp_sales_order_item soi on soi.szFSoId = so.szFSoId""",
    "or_across_tables": f"""
        select distinct si.szFSoId as si_so, si.szFPoId as si_po, soi.szProductId as soi_product
        from erp_sales_inquiry si
        left join erp_sales_order_item soi on soi.szFSoId = si.szFSoId
        left join erp_purchase_order_item poi on poi.szFPo_sId = si.szFPoId
        where {WANTED}""",
    "conditional_window": f"""
        select distinct si.szFSoId as si_so, si.szFPoId as si_po, so.dtmOrder as so_ordered,
          so.dtmCreated as so_created, po.dtmPO as po_date, gr.szFPoReceipt_sId as receipt_id
        {LINKED}
        left join erp_goods_receipt gr on gr.szPoId = po.szFPo_sId and gr.szPoId <> ''
        where {_dates(*HALF)} and so.dtmCreated >= timestamp '{HALF[0]}' and so.dtmCreated < timestamp '{HALF[1]}'""",
    "conditional_window_closed": f"""
        select distinct si.szFSoId as si_so, si.szFPoId as si_po, so.dtmOrder as so_ordered,
          so.dtmCreated as so_created, po.dtmPO as po_date, gr.szFPoReceipt_sId as receipt_id
        {LINKED}
        left join erp_goods_receipt gr on gr.szPoId = po.szFPo_sId and gr.szPoId <> ''
        where {_dates(*HALF, closed=True)}""",
    "param_window": f"""
        select szFSoId as "szFSoId", szCustId as "szCustId", dtmOrder as "dtmOrder" from erp_sales_order
        where dtmOrder >= timestamp '{HALF[0]}' and dtmOrder < timestamp '{HALF[1]}'""",
    "delivery_window": f"""
        select custOrderNo as "custOrderNo", szDoBosnetId as "szDoBosnetId", orderNo as "orderNo",
          outTime as "outTime"
        from erp_delivery_confirmation
        where outTime >= timestamp '{QUARTER[0]}' and outTime < timestamp '{QUARTER[1]}'""",
    "channel_filter": """
        select cu.szCustId as cust_id, cu.szName as cust_name, cat.szDescription as category_name
        from erp_customer cu left join erp_category cat on cat.szCategoryId = cu.szCategory_2
        where cat.szDescription in ('GT', 'MTI')""",
    "null_safe_exclude": f"""
        select distinct si.szFSoId as "szFSoId", cl.bAlreadyTransferred as "bAlreadyTransferred",
          ap.bRejected as "bRejected"
        from erp_sales_order si
        left join erp_cancel_log cl on cl.szDocId = si.szFSoId
        left join erp_approval ap on ap.gdApprovedId = si.gdApprovedId
        where {KEPT}""",
    "not_like": """
        select szFSoId as "szFSoId", szCustPoId as "szCustPoId" from erp_sales_order
        where szCustPoId not like '%RES0%' and szCustPoId not like '%RES1%' and szCustPoId not like '%RES2%'""",
    "not_in_anti": """
        select szFSoId as "szFSoId", szCustId as "szCustId", dtmOrder as "dtmOrder" from erp_sales_order
        where szFSoId not in (select szFSoId from erp_sales_inquiry)""",
    "left_join_chain": f"""
        select si.szFSoId as si_so, si.szFPoId as si_po, so.szFSoId as so_id, so.szCustPoId as so_customer_po,
          so.dtmOrder as so_ordered, po.szFPo_sId as po_id, po.dtmPO as po_date, po.szStatus as po_status
        {LINKED}""",
    "header_item_fanout": """
        select so.szFSoId as so_id, so.dtmOrder as so_ordered, soi.szProductId as soi_product,
          soi.decQty as soi_qty, soi.szOrderItemTypeId as soi_type
        from erp_sales_order so left join erp_sales_order_item soi on soi.szFSoId = so.szFSoId""",
    "dim_lookup": """
        select so.szFSoId as so_id, soi.szProductId as soi_product, p.szName as product_name,
          cu.szName as cust_name, cat.szDescription as category_name
        from erp_sales_order so
        left join erp_sales_order_item soi on soi.szFSoId = so.szFSoId
        left join erp_product p on p.szProductId = soi.szProductId
        left join erp_customer cu on cu.szCustId = so.szCustId
        left join erp_category cat on cat.szCategoryId = cu.szCategory_2""",
    "left_join_on_filter": """
        select po.szFPo_sId as po_id, gr.szFPoReceipt_sId as receipt_id, gr.dtmReceipt as receipt_date,
          tl.szDocId as log_so, tl.dtmTransferred as log_time
        from erp_purchase_order po
        left join erp_goods_receipt gr on gr.szPoId = po.szFPo_sId and gr.szPoId <> ''
        left join erp_transfer_log tl
          on tl.szDocId = 'SO' || substr(po.szFPo_sId, 3) and tl.bAlreadyTransferred""",
    "composite_key_join": """
        select si.szFSoId as si_so, soi.szProductId as soi_product, soi.szOrderItemTypeId as soi_type,
          dni.decQty as dni_qty, inv.szFInvoiceId as invoice_id, ii.decQty as item_qty
        from erp_sales_inquiry si
        left join erp_delivery_order dord on dord.szDoId = si.szFDoId
        left join erp_invoice inv on inv.szFInvoiceId = dord.szFInvoiceId
        left join erp_sales_order_item soi on soi.szFSoId = si.szFSoId
        left join erp_delivery_note_item dni on dni.szFDNId = si.szFDnId and dni.szProductId = soi.szProductId
        left join erp_invoice_item ii on ii.szFInvoiceId = inv.szFInvoiceId
          and ii.szProductId = soi.szProductId and ii.szOrderItemTypeId = soi.szOrderItemTypeId
        where coalesce(trim(si.szFSoId), '') <> ''""",
    "self_alias_join": """
        select dord.szDoId as do_id, dnew.szDoId as newdo_id, inv.szFInvoiceId as invoice_id,
          inv.dtmCreated as invoice_created, inew.szFInvoiceId as new_invoice, inew.dtmCreated as new_created
        from erp_delivery_order dord
        left join erp_delivery_history h on h.szDoIdOld = dord.szDoId
        left join erp_delivery_order dnew on dnew.szDoId = h.szDoId
        left join erp_invoice inv on inv.szFInvoiceId = dord.szFInvoiceId
        left join erp_invoice inew on inew.szFInvoiceId = dnew.szFInvoiceId""",
    "top1_correlated": f"""
        with note_status as ({NOTE_STATUS})
        select si.szFSoId as si_so, si.szFDnId as si_dn, coalesce(ns.closed, false) as closed
        from erp_sales_inquiry si left join note_status ns on ns.dn = si.szFDnId""",
    "top1_global_join": """
        with top as (select btApprovedLevel, gdApprovedId from erp_approval_item
          order by btApprovedLevel desc nulls last, gdApprovedId limit 1)
        select so.szFSoId as "szFSoId", so.gdApprovedId as "gdApprovedId", top.gdApprovedId as top_id,
          cast(top.btApprovedLevel as int) as level
        from erp_sales_order so left join top on top.gdApprovedId = so.gdApprovedId""",
    "top1_global_history": f"""
        with top as ({LATEST_HISTORY})
        select dord.szDoId as "szDoId", top.old_do, top.new_do
        from erp_delivery_order dord left join top on top.old_do = dord.szDoId""",
    "approval_pivot": """
        select so.szFSoId as "szFSoId", so.gdApprovedId as "gdApprovedId",
          a1.dtmApproved as "dtmApproved_1", a1.bApproved as "bApproved_1",
          a2.dtmApproved as "dtmApproved_2", a2.bApproved as "bApproved_2",
          a3.dtmApproved as "dtmApproved_3", a3.bApproved as "bApproved_3"
        from erp_sales_order so
        left join erp_approval_item a1 on a1.gdApprovedId = so.gdApprovedId and a1.btApprovedLevel = 1
        left join erp_approval_item a2 on a2.gdApprovedId = so.gdApprovedId and a2.btApprovedLevel = 2
        left join erp_approval_item a3 on a3.gdApprovedId = so.gdApprovedId and a3.btApprovedLevel = 3""",
    "unused_join_elim": f"""
        select distinct si.szFSoId as si_so, si.szFPoId as si_po, so.dtmOrder as so_ordered, po.dtmPO as po_date
        {LINKED}
        left join erp_goods_receipt gr on gr.szPoId = po.szFPo_sId and gr.szPoId <> ''
        left join erp_goods_receipt_item gri on gri.szFPoReceipt_sId = gr.szFPoReceipt_sId
        left join erp_wms_operate_time wt on wt.CustOrderNo = so.szFSoId
        left join erp_cancel_log cd on cd.szDocId = si.szFSoId and cd.bAlreadyTransferred""",
    "outer_to_inner": f"""
        select si.szFSoId as si_so, so.dtmCreated as so_created, cu.szName as cust_name,
          cat.szDescription as category_name
        from erp_sales_inquiry si
        left join erp_sales_order so on so.szFSoId = si.szFSoId
        left join erp_customer cu on cu.szCustId = si.szCustId
        left join erp_category cat on cat.szCategoryId = cu.szCategory_2
        where so.dtmCreated >= timestamp '{HALF[0]}' and so.dtmCreated < timestamp '{HALF[1]}'
          and cat.szDescription in ('GT', 'MTI')""",
    "delivered_qty": f"""
        with delivered as ({DELIVERED})
        select so.szFSoId as si_so, dc.orderNo as delv_no, soi.szProductId as soi_product,
          coalesce(dq.qty, 0) as qty
        from erp_sales_order so
        left join erp_delivery_confirmation dc on dc.custOrderNo = so.szFSoId and dc.custOrderNo <> ''
        left join erp_sales_order_item soi on soi.szFSoId = so.szFSoId
        left join delivered dq
          on dq.custOrderNo = dc.custOrderNo and dq.orderNo = dc.orderNo and dq.code = soi.szProductId""",
    "invoice_qty": """
        select szFInvoiceId as "szFInvoiceId", szProductId as "szProductId", sum(decQty) as "decQty"
        from erp_invoice_item group by 1, 2""",
    "bonus_rollup": f"with bonus as ({_bonus(None)}) select {BONUS_COLUMNS} from bonus b",
    "bonus_rollup_since": f"""
        with bonus as ({_bonus("> timestamp '1998-01-01'")}) select {BONUS_COLUMNS} from bonus b""",
    "buy_item_flag": """
        select distinct szFPo_sId as "szFPo_sId" from erp_purchase_order_item
        where purchaseItemTypeId in ('BELI', 'BELI-BERIKAT')""",
    "select_distinct": """
        select distinct szFSoId as "szFSoId", szParentId as "szParentId", szPaymentType as "szPaymentType",
          szOrderItemTypeId as "szOrderItemTypeId", bTaxable as "bTaxable"
        from erp_sales_order_item""",
    "date_to_text": """
        select szFPo_sId as "szFPo_sId", strftime(dtmCreated, '%Y-%m-%d %H:%M:%S') as date_created,
          dtmPO as "dtmPO"
        from erp_purchase_order""",
    "date_to_text_as_source": f"""
        with made as (
          select szFPo_sId, date_trunc('day', dtmCreated)::timestamp as created_day,
            date_trunc('day', dtmCreated)::timestamp + to_minutes(length(szFPo_sId)) as created_second,
            case when szFPo_sId like '%7' then dtmCreated end as created_some
          from erp_purchase_order)
        select szFPo_sId as "szFPo_sId", {_as_source('created_day')}, {_as_source('created_second')}, {_as_source('created_some')}
        from made""",
    "bonus_state": f"""
        with bonus as ({_bonus(None)}) select {BONUS_COLUMNS} from bonus b
        where b.szFSoId in (select szFSoId from erp_sales_order where dtmOrder is not null)""",
    "sink_overwrite": """
        select szFPo_sId as "szFPo_sId", strftime(dtmCreated, '%Y-%m-%d %H:%M:%S') as date_created
        from erp_purchase_order""",
    "sink_month_partition": f"""
        select szFSoId as "szFSoId", dtmOrder as "dtmOrder",
          case when dtmOrder >= timestamp '{HALF[0]}' and dtmOrder < timestamp '{HALF[1]}' then 2 else 1 end
            as version,
          strftime(dtmOrder, '%Y-%m') as period
        from erp_sales_order""",
    "sink_month_rerun": """
        select szFSoId as "szFSoId", dtmOrder as "dtmOrder", 2 as version, '1998-01' as period
        from erp_sales_order
        where dtmOrder >= timestamp '1998-01-01' and dtmOrder < timestamp '1998-02-04'
        union all
        select szFSoId, dtmOrder, 1, '1998-02' from erp_sales_order
        where dtmOrder >= timestamp '1998-02-01' and dtmOrder < timestamp '1998-03-01'""",
    "shipment_load": "select * from erp_delivery_order",
    "enrich_distributor": f"""
        with month as ({with_bridge(po_tracking_month_sql(*ALL))})
        select distinct m.purchase_order_number, m.sales_order_number, m.customer_id, m.product_id,
          'C' || cast(s.s_suppkey as varchar) as distributor_id, s.s_name as distributor_name
        from month m left join supplier s on 'C' || cast(s.s_suppkey as varchar) = m.customer_id""",
}

ORACLE: dict[str, str] = {
    name: sql if name == "enrich_distributor" else with_bridge(sql) for name, sql in _ORACLE.items()
}

_MONTH_TEXTS = (
    "purchase_order_number", "sales_order_number", "customer_id", "customer_name",
    "customer_category_description", "product_id", "product_name", "szfdnid",
)
ORACLE["po_tracking_mtd_ignore_case"] = f"""
    select distinct * replace ({', '.join(f'upper(rtrim({c})) as {c}' for c in _MONTH_TEXTS)})
    from ({ORACLE["po_tracking_mtd"]})"""

_SKEWED = skewed_views()
for _name in ("po_tracking_mtd", "po_tracking_3m", "so_tracking_inquiry", "so_tracking_no_inquiry"):
    ORACLE[f"{_name}_skewed"] = with_bridge(_ORACLE[_name], _SKEWED)

_MARCH = ("1998-03-01", "1998-04-01")


def _keys(dataset: str, sql: str, po: str, so: str, customer: str, product: str, amount: str, delivered: str = "null") -> str:
    return f"""
    select '{dataset}' as dataset, {po} as po, {so} as so, {customer} as customer, {product} as product,
      {amount}::double as amount, {delivered}::double as delivered
    from ({with_bridge(sql)})"""


_NARROW = ("purchase_order_number", "sales_order_number", "customer_id", "product_id", "nett_amount_incl_ppn")
_WIDE = ("szFPOid", "szFSoId", "szCustId", "szProductId", "decDisc1DPP")
ORACLE["four_datasets"] = " union all ".join(
    (
        _keys("month", po_tracking_month_sql(*_MARCH), *_NARROW),
        _keys("quarter", po_tracking_by_delivery_sql("1998-01-01", "1998-04-01", *_MARCH), *_NARROW, "qty_delivered"),
        _keys("inquiry", so_tracking_inquiry_sql("1998-03-01", "1998-03-31 23:59:59.999999"), *_WIDE, "decQtyDelivered"),
        _keys("no-inquiry", so_tracking_no_inquiry_sql(*_MARCH), *_WIDE),
    )
)
