"""Table migration and reconciliation on Spark DataFrames."""

from tabsync.spec import FieldMeta, Ref, TableSpec

__all__ = ["FieldMeta", "Ref", "TableSpec"]
