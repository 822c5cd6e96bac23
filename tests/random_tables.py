"""Small random base tables full of blank, padded, NULL and repeated ids."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from orderweave.sources.schema import COLUMNS

# Fixed values the plans test for.
_WORDS = {
    "szOrderItemTypeId": ["JUAL", "JUAL", "BONUS"],
    "purchaseItemTypeId": ["BELI", "BELI-BERIKAT", "LAIN"],
    "szPrincipalDiscRefId": ["Invoice Disc. Item", "Invoice Disc. Item 2", "Invoice Disc.", "Other"],
    "szDescription": ["GT", "MTI", "OTHER"],
    "szCustPoId": ["", " ", " CP1", "CP2 ", "RES0-1", "XRES2", "RES7"],
    "szParentId": ["PR0", "PR1"],
    "szPaymentType": ["O", "F"],
    "szStatus": ["F", "O"],
    "szData": ["cancel", "retry"],
    "szName": ["first", "second"],
}
# Id columns that refer to the same documents share a prefix.
_PREFIX = {
    "szFSoId": "SO", "custOrderNo": "SO", "CustOrderNo": "SO", "szDocId": "SO",
    "szFPoId": "PO", "szFPo_sId": "PO", "szPoId": "PO",
    "szFDoId": "DO", "szDoId": "DO", "szDoIdOld": "DO", "szFDoReffId": "DO", "szDoBosnetId": "DO",
    "szFDnId": "DN", "szFDNId": "DN", "szDNId": "DN",
    "szFInvoiceId": "IV", "szProductId": "P", "code": "P", "gdApprovedId": "GD",
    "szCustId": "C", "szCategory_2": "K", "szCategoryId": "K", "szCloseDNId": "CL",
    "szFPoReceipt_sId": "GR", "orderNo": "W",
}
_ARROW = {
    "text": pa.string(),
    "int": pa.int32(),
    "short": pa.int16(),
    "byte": pa.int8(),
    "time": pa.timestamp("us"),
    "flag": pa.bool_(),
    "money": pa.float64(),
}
# Rows that mostly continue a row of another table: child, parent, columns.
_ITEM = ("szFSoId", "shItemNumber", "szProductId", "szParentId", "szPaymentType", "szOrderItemTypeId")
_LINKS = (
    ("delivery_confirmation", "sales_inquiry", {"custOrderNo": "szFSoId", "szDoBosnetId": "szFDoId"}),
    ("delivery_confirmation_item", "delivery_confirmation", {"custOrderNo": "custOrderNo", "orderNo": "orderNo"}),
    ("bonus_source", "sales_order_item", {c: c for c in _ITEM}),
)
_START = datetime(2024, 11, 28)


def _value(rng: random.Random, column: str, kind: str, ids: int, blank: float):
    if rng.random() < 0.06:
        return None
    if kind == "text":
        if column in _WORDS:
            return rng.choice(_WORDS[column])
        if rng.random() < blank:
            return rng.choice(["", "", " "])
        return f"{_PREFIX.get(column, 'X')}{rng.randrange(ids)}"
    if kind == "time":
        return _START + timedelta(hours=12 * rng.randrange(80))
    if kind == "flag":
        return rng.random() < 0.5
    if kind == "money":
        return rng.choice([0.0, 0.0, 1.5, 12.25, 100.0, 7.75])
    return rng.randrange(1, 4)


def write_tables(
    root: Path, seed: int, rows: int = 14, ids: int = 9, blank: float = 0.12
) -> dict[str, str]:
    """One parquet file per table; returns their paths.

    No inquiry has a NULL order id: one would empty the orders without inquiry.
    """
    rng = random.Random(seed)
    data: dict[str, list[dict]] = {}
    for name, kinds in COLUMNS.items():
        columns = {c: kind for kind, names in kinds.items() for c in names.split()}
        count = rows * 2 if name in ("sales_inquiry", "sales_order") else rows
        data[name] = [
            {c: _value(rng, c, kind, ids, blank) for c, kind in columns.items()} for _ in range(count)
        ]
    for row in data["sales_inquiry"]:
        row["szFSoId"] = row["szFSoId"] or ""
    for child, parent, shared in _LINKS:
        for row in data[child]:
            if rng.random() < 0.7:
                source = rng.choice(data[parent])
                row.update({ours: source[theirs] for ours, theirs in shared.items()})
    paths = {}
    for name, kinds in COLUMNS.items():
        data[name] += [rng.choice(data[name]) for _ in range(2)]  # exact copies
        schema = pa.schema([(c, _ARROW[k]) for k, names in kinds.items() for c in names.split()])
        paths[name] = str(root / name)
        pq.write_table(pa.Table.from_pylist(data[name], schema=schema), paths[name])
    return paths
