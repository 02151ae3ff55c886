"""The warehouse as Spark catalog tables, and the SQL front over it."""

from gleaner.catalog.warehouse import Warehouse, classify_statements, is_write_statement

__all__ = ["Warehouse", "classify_statements", "is_write_statement"]
