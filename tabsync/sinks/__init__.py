"""Bundles on disk, reports, previews."""

from tabsync.sinks.bundle import (MANIFEST_SCHEMA, build_manifest, read_table, table_path, write_csv,
                                  write_diff, write_results, write_table)
from tabsync.sinks.report import discovery_report, plan_report

__all__ = ["MANIFEST_SCHEMA", "build_manifest", "discovery_report", "plan_report", "read_table",
           "table_path", "write_csv", "write_diff", "write_results", "write_table"]
