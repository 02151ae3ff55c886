"""Warehouse sinks: versioned directory tables and the write strategies."""

from gleaner.sinks.table import VersionedTable
from gleaner.sinks.write import append, full_refresh, staged_merge, staged_write, upsert, write

__all__ = ["VersionedTable", "append", "full_refresh", "staged_merge", "staged_write", "upsert", "write"]
