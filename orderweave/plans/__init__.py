"""The end datasets, built from base tables and date parameters."""

from .enrich import enrich_with_distributor
from .po_tracking import po_tracking_by_delivery, po_tracking_month
from .so_tracking import so_tracking_inquiry, so_tracking_no_inquiry
from .stages import Stages

__all__ = [
    "Stages",
    "enrich_with_distributor",
    "po_tracking_by_delivery",
    "po_tracking_month",
    "so_tracking_inquiry",
    "so_tracking_no_inquiry",
]
