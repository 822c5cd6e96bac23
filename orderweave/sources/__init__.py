"""Base tables: schemas, registry and readers."""

from .jdbc import JdbcSource
from .tables import Tables

__all__ = ["JdbcSource", "Tables"]
