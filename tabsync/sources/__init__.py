"""Reading tables: scans, filters along references, CSV files, table inventory."""

from tabsync.sources.catalog import (column_inventory, discover_tables, row_counts, usable_table_names)
from tabsync.sources.csv import read_csv
from tabsync.sources.tables import (assign_batches, in_list, merge_column_groups, path_filter, read_env,
                                  scan, select_columns)

__all__ = ["assign_batches", "column_inventory", "discover_tables", "in_list", "merge_column_groups",
           "path_filter", "read_csv", "read_env", "row_counts", "scan", "select_columns",
           "usable_table_names"]
