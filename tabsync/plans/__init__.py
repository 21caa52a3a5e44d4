"""Whole runs, put together from the operators."""

from tabsync.plans.compare import compare, export_delta
from tabsync.plans.discover import discover, plan
from tabsync.plans.export import Bundle, export
from tabsync.plans.load import LoadResult, LoadStopped, load, load_preview
from tabsync.plans.rollback import rollback

__all__ = ["Bundle", "LoadResult", "LoadStopped", "compare", "discover", "export", "export_delta", "load", "load_preview",
           "plan", "rollback"]
