"""The base tables of the order system, derived from the TPC-H-like test tables.

The remainders decide which documents an order has (a purchase order, a
delivery, ...), as `FIXTURES.md` lists them, and where ids are blank or NULL.  The same text runs in Spark and in DuckDB; `{orders}` and its
like stand for the test tables.
"""

from __future__ import annotations

import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from orderweave.sources import Tables
from orderweave.sources.schema import COLUMNS

VIEWS: dict[str, str] = {
    "sales_inquiry": """
        select case when o_orderkey%10=0 then '' else 'SO' || cast(o_orderkey as string) end as szFSoId,
          case when o_orderkey%4=0 then '' else 'PO' || cast(o_orderkey as string) end as szFPoId,
          'C' || cast(o_custkey as string) as szCustId,
          case when o_orderkey%5=0 then '' else 'DO' || cast(o_orderkey as string) end as szFDoId,
          case when o_orderkey%3=0 then 'DN' || cast(o_orderkey as string) else '' end as szFDnId,
          case when o_orderkey%9=0 then null else cast(o_orderkey%3 as int) end as istatusFlag,
          'CR' || cast(o_orderkey%7 as string) as szCarrierId,
          'V' || cast(o_orderkey%50 as string) as szVehicleNo,
          'D' || cast(o_orderkey%40 as string) as szDriverNm,
          o_orderdate + interval '5' day as dtmETA, o_orderkey%2=0 as bSentWMS
        from {orders} where o_orderkey%6<>5""",
    "sales_order": """
        select 'SO' || cast(o_orderkey as string) as szFSoId,
          case o_orderkey%7 when 0 then null when 1 then ' '
            when 2 then 'RES' || cast(o_orderkey%5 as string) || '-' || cast(o_orderkey as string)
            else ' CP' || cast(o_orderkey as string) end as szCustPoId,
          'GD' || cast(o_orderkey as string) as gdApprovedId,
          'C' || cast(o_custkey as string) as szCustId,
          o_orderpriority as szPaymentTermId, o_orderstatus as szOrdertypeId,
          o_orderdate as dtmOrder, o_orderdate + (o_orderkey%3) * interval '1' day as dtmCreated,
          case when o_orderkey%8=0 then null else o_orderstatus='F' end as bApplied,
          o_orderkey%11=0 as bVoid, 'DO' || cast(o_orderkey as string) as szFDoReffId
        from {orders} where o_orderkey%10<>0""",
    "sales_order_item": """
        select 'SO' || cast(l_orderkey as string) as szFSoId, cast(l_linenumber as smallint) as shItemNumber,
          'P' || cast(l_partkey as string) as szProductId,
          case when l_linenumber=7 then 0.0e0 else l_quantity end as decQty, l_quantity*12 as decUomQty,
          l_extendedprice as decAmount, l_tax>0.02 as bTaxable,
          case when l_linenumber=6 then 0.0e0 else l_extendedprice*(1-l_discount) end as decDPP,
          case when l_linenumber=6 then 0.0e0 else l_extendedprice*l_tax end as decTax,
          l_extendedprice/l_quantity as decPrice,
          case when l_returnflag='R' then 'BONUS' else 'JUAL' end as szOrderItemTypeId,
          'PR' || cast(l_suppkey%3 as string) as szParentId, l_linestatus as szPaymentType,
          case l_linenumber%4 when 0 then 'Invoice Disc. Item' when 1 then 'Invoice Disc. Item 2'
            when 2 then 'Invoice Disc.' else 'Other' end as szPrincipalDiscRefId
        from {lineitem} where l_orderkey%10<>0""",
    "bonus_source": """
        select 'SO' || cast(l_orderkey as string) as szFSoId, cast(l_linenumber as smallint) as shItemNumber,
          case when l_suppkey%13=0 then null else 'P' || cast(l_partkey as string) end as szProductId,
          'PR' || cast(l_suppkey%3 as string) as szParentId, l_linestatus as szPaymentType,
          case when l_returnflag='R' then 'BONUS' else 'JUAL' end as szOrderItemTypeId,
          l_extendedprice*l_discount as decBonusAmount
        from {lineitem} where l_orderkey%10<>0 and l_quantity>10""",
    "purchase_order": """
        select 'PO' || cast(o_orderkey as string) as szFPo_sId,
          case when o_orderkey%9=0 then null else o_orderstatus end as szStatus,
          o_orderdate + interval '1' day as dtmCreated, o_orderdate as dtmPO, o_orderkey%15=0 as bVoid
        from {orders} where o_orderkey%4<>0""",
    "purchase_order_item": """
        select 'PO' || cast(l_orderkey as string) as szFPo_sId, 'P' || cast(l_partkey as string) as szProductId,
          l_quantity as decQty, l_extendedprice as decAmount, l_extendedprice*(1-l_discount) as decDPP,
          l_extendedprice*l_tax as decPPN, l_extendedprice*l_discount as decDiscount,
          l_extendedprice/l_quantity as decPrice, l_tax>0.02 as bTaxable,
          case when l_linestatus='O' then 'BELI' when l_returnflag='A' then 'BELI-BERIKAT' else 'LAIN' end
            as purchaseItemTypeId
        from {lineitem} where l_orderkey%4<>0 and l_linenumber<=2""",
    "product": "select 'P' || cast(p_partkey as string) as szProductId, p_name as szName from {part}",
    "customer": """
        select 'C' || cast(c_custkey as string) as szCustId, c_name as szName, c_mktsegment as szCategory_2
        from {customer}""",
    "category": """
        select distinct c_mktsegment as szCategoryId,
          case c_mktsegment when 'BUILDING' then 'GT' when 'HOUSEHOLD' then 'GT' when 'MACHINERY' then 'MTI'
            else 'OTHER' end as szDescription
        from {customer} where c_mktsegment<>'FURNITURE'""",
    "goods_receipt": """
        select 'GR' || cast(o_orderkey as string) as szFPoReceipt_sId,
          case when o_orderkey%17=0 then '' else 'PO' || cast(o_orderkey as string) end as szPoId,
          o_orderdate + interval '7' day as dtmReceipt, o_orderdate + interval '8' day as dtmCreated
        from {orders} where o_orderkey%4 in (1,2)
        union all
        select 'GRB' || cast(o_orderkey as string), 'PO' || cast(o_orderkey as string),
          o_orderdate + interval '9' day, o_orderdate + interval '9' day
        from {orders} where o_orderkey%12=1""",
    "goods_receipt_item": """
        select 'GR' || cast(l_orderkey as string) as szFPoReceipt_sId, 'P' || cast(l_partkey as string) as szProductId
        from {lineitem} where l_orderkey%4 in (1,2) and l_linenumber<=2""",
    "delivery_order": """
        select 'DO' || cast(o_orderkey as string) as szDoId,
          case when o_orderkey%3=2 then '' else 'IV' || cast(o_orderkey as string) end as szFInvoiceId,
          case when o_orderkey%7=0 then null else o_orderdate + interval '3' day end as dtmDelivery,
          o_orderdate + interval '2' day as dtmCreated, 'CR' || cast(o_orderkey%7 as string) as szCarrierId,
          'V' || cast(o_orderkey%50 as string) as szVehicleNumber,
          'D' || cast(o_orderkey%40 as string) as szDriverName
        from {orders} where o_orderkey%5<>0""",
    "delivery_confirmation": """
        select case when o_orderkey%10=0 then '' else 'SO' || cast(o_orderkey as string) end as custOrderNo,
          'DO' || cast(o_orderkey as string) as szDoBosnetId, 'W' || cast(o_orderkey as string) as orderNo,
          o_orderdate + interval '4' day as outTime
        from {orders} where o_orderkey%5 in (1,2,3)""",
    "delivery_confirmation_item": """
        select 'SO' || cast(l_orderkey as string) as custOrderNo, 'W' || cast(l_orderkey as string) as orderNo,
          'P' || cast(l_partkey as string) as code, l_quantity as qty
        from {lineitem} where l_orderkey%5 in (1,2,3) and l_linenumber<=5""",
    "invoice": """
        select 'IV' || cast(o_orderkey as string) as szFInvoiceId, o_orderdate + interval '6' day as dtmCreated
        from {orders} where o_orderkey%5<>0 and o_orderkey%3<>2""",
    "invoice_item": """
        select 'IV' || cast(l_orderkey as string) as szFInvoiceId, 'P' || cast(l_partkey as string) as szProductId,
          case when l_returnflag='R' then 'BONUS' else 'JUAL' end as szOrderItemTypeId, l_quantity as decQty
        from {lineitem} where l_orderkey%5<>0 and l_orderkey%3<>2""",
    "transfer_log": """
        select 'SO' || cast(o_orderkey as string) as szDocId, o_orderkey%3<>0 as bAlreadyTransferred,
          o_orderdate + interval '2' day as dtmTransferred
        from {orders} where o_orderkey%2=1""",
    "cancel_log": """
        select 'SO' || cast(o_orderkey as string) as szDocId, true as bAlreadyTransferred, 'cancel' as szData
        from {orders} where o_orderkey%13=0
        union all
        select 'SO' || cast(o_orderkey as string), false, 'retry'
        from {orders} where o_orderkey%26=0 or o_orderkey%13=1""",
    "approval_item": """
        select 'GD' || cast(o_orderkey as string) as gdApprovedId, cast(1 as tinyint) as btApprovedLevel,
          case when o_orderkey%6=0 then null else o_orderdate + interval '1' day end as dtmApproved,
          o_orderkey%3<>0 as bApproved
        from {orders} where o_orderkey%4>=1
        union all
        select 'GD' || cast(o_orderkey as string), cast(2 as tinyint),
          case when o_orderkey%6=0 then null else o_orderdate + interval '2' day end, o_orderkey%4<>0
        from {orders} where o_orderkey%4>=2
        union all
        select 'GD' || cast(o_orderkey as string), cast(3 as tinyint),
          case when o_orderkey%6=0 then null else o_orderdate + interval '3' day end, o_orderkey%5<>0
        from {orders} where o_orderkey%4>=3""",
    "approval": """
        select 'GD' || cast(o_orderkey as string) as gdApprovedId, o_orderkey%9=0 as bRejected
        from {orders} where o_orderkey%3=0""",
    "delivery_note": """
        select 'DN' || cast(o_orderkey as string) as szFDNId, o_orderdate + interval '10' day as dtmLastUpdated
        from {orders} where o_orderkey%3=0 and o_orderkey%7<>0""",
    "delivery_note_item": """
        select 'DN' || cast(l_orderkey as string) as szFDNId, 'P' || cast(l_partkey as string) as szProductId,
          l_quantity as decQty
        from {lineitem} where l_orderkey%3=0 and l_orderkey%7<>0 and l_linenumber<=4""",
    "note_closing": """
        select 'CL' || cast(o_orderkey as string) as szCloseDNId, o_orderkey%2=0 as bApplied,
          case when o_orderkey%15=0 then null else o_orderdate + interval '11' day end as dtmLastUpdated
        from {orders} where o_orderkey%3=0
        union all
        select 'CM' || cast(o_orderkey as string), o_orderkey%2<>0, o_orderdate + interval '12' day
        from {orders} where o_orderkey%12=0""",
    "note_closing_item": """
        select 'CL' || cast(o_orderkey as string) as szCloseDNId, 'DN' || cast(o_orderkey as string) as szDNId
        from {orders} where o_orderkey%3=0
        union all
        select 'CM' || cast(o_orderkey as string), 'DN' || cast(o_orderkey as string)
        from {orders} where o_orderkey%12=0""",
    "delivery_history": """
        select 'DO' || cast((o_orderkey+1) as string) as szDoId, 'DO' || cast(o_orderkey as string) as szDoIdOld,
          o_orderdate + interval '9' day as dtmLastUpdated
        from {orders} where o_orderkey%5 in (1,2)""",
    "wms_operate_time": """
        select 'SO' || cast(o_orderkey as string) as CustOrderNo from {orders} where o_orderkey%2=0""",
}

# Awkward ids over the same tables: three orders and three purchase orders without an
# id, with their items; NULL and padded ids; one purchase order and one delivery
# note that a good part of the inquiries name; repeated inquiries.
_BLANK = "in ('{0}1', '{0}33', '{0}66')"
CHANGED: dict[str, dict[str, str]] = {
    "sales_order": {"szFSoId": f"case when szFSoId {_BLANK.format('SO')} then ' ' else szFSoId end"},
    "sales_order_item": {"szFSoId": f"case when szFSoId {_BLANK.format('SO')} then ' ' else szFSoId end"},
    "bonus_source": {"szFSoId": f"case when szFSoId {_BLANK.format('SO')} then ' ' else szFSoId end"},
    "purchase_order": {"szFPo_sId": f"case when szFPo_sId {_BLANK.format('PO')} then '' else szFPo_sId end"},
    "purchase_order_item": {"szFPo_sId": f"case when szFPo_sId {_BLANK.format('PO')} then '' else szFPo_sId end"},
    "transfer_log": {"szDocId": f"case when szDocId {_BLANK.format('SO')} then ' ' else szDocId end"},
    "sales_inquiry": {
        "szFSoId": "case when szFSoId in ('', 'SO1') then ' ' when szCarrierId = 'CR4' and szFSoId like '%9' then null else szFSoId end",
        "szFPoId": "case when szVehicleNo like '%7' then 'PO5' when szFPoId in ('PO33', 'PO66') then '' else szFPoId end",
        "szCustId": "case when szDriverNm = 'D8' then szCustId || ' ' when szDriverNm = 'D9' then null else szCustId end",
        "szFDnId": "case when szVehicleNo like '%3' then 'DN3' else szFDnId end",
    },
}


def skewed_views() -> dict[str, str]:
    """The views with the ids above; every inquiry of some carriers occurs three times."""
    views = dict(VIEWS)
    for name, changed in CHANGED.items():
        columns = ", ".join(f"{changed[c]} as {c}" if c in changed else c for c in stored_columns(name))
        views[name] = f"select {columns} from ({VIEWS[name]})"
    again = "(select 0 as copy union all select 1 union all select 2)"
    inquiry = ", ".join(stored_columns("sales_inquiry"))
    views["sales_inquiry"] = (
        f"select {inquiry} from ({views['sales_inquiry']}) q join {again} c on c.copy = 0 or q.szCarrierId = 'CR2'"
    )
    return views


def stored_columns(name: str) -> list[str]:
    return " ".join(COLUMNS[name].values()).split()


_INPUT = re.compile(r"\{(\w+)\}")


# Schemas of the test tables, so that opening one reads no file.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


_DEFINED: WeakKeyDictionary = WeakKeyDictionary()


def bridge_tables(spark: SparkSession, sf_dir: str, views: dict[str, str] = VIEWS) -> Tables:
    """The base tables as lazy Spark frames over `sf_dir`; a session defines them once."""
    inputs, frames = _DEFINED.setdefault(spark, {}).setdefault((sf_dir, views is VIEWS), ({}, {}))

    def load(name: str) -> DataFrame:
        if name in frames:
            return frames[name]
        text = views[name]
        used = set(_INPUT.findall(text))
        for table in used - inputs.keys():
            inputs[table] = spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")
        frames[name] = spark.sql(text, **{table: inputs[table] for table in used})
        return frames[name]

    return Tables(spark, load)


def with_bridge(sql: str, views: dict[str, str] = VIEWS) -> str:
    """`sql` over `erp_*` tables, preceded by the views it names."""
    names = [name for name in views if re.search(rf"\berp_{name}\b", sql)]
    ctes = ",\n".join(f"erp_{name} as ({_INPUT.sub(r'\1', views[name])})" for name in names)
    sql = sql.strip()
    if sql[:5].lower() == "with ":
        return f"with {ctes},\n{sql[5:]}"
    return f"with {ctes}\n{sql}"
