"""Schemas of the base tables.

`SOURCE_TABLES` maps our table name to the table name in the source database;
`COLUMNS` lists the columns the datasets read.  Both are fixed values: they
must equal the source system's names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table names in the source database.
SOURCE_TABLES: dict[str, str] = {
    "sales_inquiry": "msyn_sd_salesinquiry",
    "sales_order": "bos_sd_fso",
    "sales_order_item": "BOS_SD_FSoItem",
    "bonus_source": "BOS_SD_FSoItemBonusSource",
    "purchase_order": "BOS_PUR_FPo_s",
    "purchase_order_item": "BOS_PUR_FPo_sItem",
    "goods_receipt": "BOS_PUR_FPoReceipt_s",
    "goods_receipt_item": "BOS_PUR_FPoReceipt_sItem",
    "product": "BOS_INV_Product",
    "customer": "bos_ar_customer",
    "category": "BOS_AR_Category",
    "delivery_order": "BOS_SD_FDo",
    "delivery_confirmation": "MSYN_INT_WMS_DeliveryConfirmation",
    "delivery_confirmation_item": "MSYN_INT_WMS_DeliveryConfirmationItem",
    "invoice": "BOS_SD_FInvoice",
    "invoice_item": "BOS_SD_FInvoiceItem",
    "transfer_log": "MSYN_INT_PurchaseOrder",
    "cancel_log": "MSYN_INT_PurchaseCancelOrder",
    "approval_item": "BOS_GEN_ApprovedItem",
    "approval": "BOS_GEN_Approved",
    "delivery_note": "MSYN_INV_FDn",
    "delivery_note_item": "MSYN_INV_FDnItem",
    "note_closing": "MSYN_INV_CloseDN",
    "note_closing_item": "MSYN_INV_CloseDNItem",
    "delivery_history": "MSYN_INV_HistoryDODn",
    "wms_operate_time": "MSYN_INT_WMS_OperateTime",
}

# Column names in the source database, by kind.
COLUMNS: dict[str, dict[str, str]] = {
    "sales_inquiry": {
        "text": "szFSoId szFPoId szCustId szFDoId szFDnId szCarrierId szVehicleNo szDriverNm",
        "int": "istatusFlag",
        "time": "dtmETA",
        "flag": "bSentWMS",
    },
    "sales_order": {
        "text": "szFSoId szCustPoId gdApprovedId szCustId szPaymentTermId szOrdertypeId szFDoReffId",
        "time": "dtmCreated dtmOrder",
        "flag": "bApplied bVoid",
    },
    "sales_order_item": {
        "text": "szFSoId szProductId szOrderItemTypeId szParentId szPaymentType szPrincipalDiscRefId",
        "short": "shItemNumber",
        "money": "decQty decUomQty decAmount decDPP decTax decPrice",
        "flag": "bTaxable",
    },
    "bonus_source": {
        "text": "szFSoId szProductId szParentId szPaymentType szOrderItemTypeId",
        "short": "shItemNumber",
        "money": "decBonusAmount",
    },
    "purchase_order": {"text": "szFPo_sId szStatus", "time": "dtmCreated dtmPO", "flag": "bVoid"},
    "purchase_order_item": {
        "text": "szFPo_sId szProductId purchaseItemTypeId",
        "money": "decQty decPPN decDPP decAmount decDiscount decPrice",
        "flag": "bTaxable",
    },
    "goods_receipt": {"text": "szFPoReceipt_sId szPoId", "time": "dtmCreated dtmReceipt"},
    "goods_receipt_item": {"text": "szFPoReceipt_sId szProductId"},
    "product": {"text": "szProductId szName"},
    "customer": {"text": "szCustId szName szCategory_2"},
    "category": {"text": "szCategoryId szDescription"},
    "delivery_order": {
        "text": "szDoId szFInvoiceId szCarrierId szVehicleNumber szDriverName",
        "time": "dtmCreated dtmDelivery",
    },
    "delivery_confirmation": {"text": "custOrderNo orderNo szDoBosnetId", "time": "outTime"},
    "delivery_confirmation_item": {"text": "custOrderNo orderNo code", "money": "qty"},
    "invoice": {"text": "szFInvoiceId", "time": "dtmCreated"},
    "invoice_item": {"text": "szFInvoiceId szProductId szOrderItemTypeId", "money": "decQty"},
    "transfer_log": {"text": "szDocId", "flag": "bAlreadyTransferred", "time": "dtmTransferred"},
    "cancel_log": {"text": "szDocId szData", "flag": "bAlreadyTransferred"},
    "approval_item": {
        "text": "gdApprovedId",
        "byte": "btApprovedLevel",
        "time": "dtmApproved",
        "flag": "bApproved",
    },
    "approval": {"text": "gdApprovedId", "flag": "bRejected"},
    "delivery_note": {"text": "szFDNId", "time": "dtmLastUpdated"},
    "delivery_note_item": {"text": "szFDNId szProductId", "money": "decQty"},
    "note_closing": {"text": "szCloseDNId", "flag": "bApplied", "time": "dtmLastUpdated"},
    "note_closing_item": {"text": "szCloseDNId szDNId"},
    "delivery_history": {"text": "szDoId szDoIdOld", "time": "dtmLastUpdated"},
    "wms_operate_time": {"text": "CustOrderNo"},
}

# Column that the large tables are joined on: the one to bucket their copies by.
BUCKET_COLUMNS: dict[str, str] = {
    "sales_order": "szFSoId",
    "sales_order_item": "szFSoId",
    "bonus_source": "szFSoId",
    "purchase_order": "szFPo_sId",
    "purchase_order_item": "szFPo_sId",
    "goods_receipt": "szPoId",
    "delivery_order": "szDoId",
    "delivery_confirmation": "custOrderNo",
    "delivery_confirmation_item": "custOrderNo",
    "invoice": "szFInvoiceId",
    "invoice_item": "szFInvoiceId",
    "transfer_log": "szDocId",
    "cancel_log": "szDocId",
    "approval_item": "gdApprovedId",
    "approval": "gdApprovedId",
    "delivery_note": "szFDNId",
    "delivery_note_item": "szFDNId",
}

MONEY = T.DecimalType(18, 4)


def table_schema(name: str, money: T.DataType = MONEY) -> T.StructType:
    """All columns nullable, as in the source."""
    kinds: dict[str, T.DataType] = {
        "text": T.StringType(),
        "int": T.IntegerType(),
        "short": T.ShortType(),
        "byte": T.ByteType(),
        "time": T.TimestampNTZType(),
        "flag": T.BooleanType(),
        "money": money,
    }
    return T.StructType(
        [
            T.StructField(column, kinds[kind], True)
            for kind, columns in COLUMNS[name].items()
            for column in columns.split()
        ]
    )

# Headers that datasets cut by date: staged by month of this column, which they then also carry as text.
MONTH_COLUMNS = {"sales_order": "dtmOrder", "purchase_order": "dtmPO"}
STORED_MONTH = "stored_month"
