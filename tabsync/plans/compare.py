"""Two environments to a diff, and a diff to a delta bundle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F

from tabsync.operators.diff import Diff, diff_all, extract_delta
from tabsync.operators.resolve import id_maps
from tabsync.operators.subset import subset_portable
from tabsync.plans.export import Bundle, resolved_parts, write_bundle
from tabsync.sources.tables import scan
from tabsync.spec import Env, FieldMeta, TableSpec, by_name, load_order, table_tiers


def compare(src_env: Env, tgt_env: Env, specs: Sequence[TableSpec], only: str | None = None,
            root: str | None = None, values=None, match_by: str = "name",
            fields: Mapping[str, Sequence[FieldMeta]] | None = None) -> Diff:
    """Diff of all tables, of one table, or of the rows related to some root rows."""
    if only is not None:
        specs = [s for s in specs if s.name == only]
        if not specs:
            raise ValueError(f"table {only} is not among the specs")
    if root is not None:
        src_env, tgt_env = subset_portable(src_env, tgt_env, specs, root, values, match_by)
    return diff_all(src_env, tgt_env, specs, fields)


def export_delta(src_env: Env, diff: Diff, specs: Sequence[TableSpec], path: str, fmt: str = "parquet",
                 fields: Mapping[str, Sequence[FieldMeta]] | None = None) -> Bundle:
    """Write the new and modified rows, resolved like a full export."""
    specs = [s for s in specs if s.name in src_env]
    tiers, maps = table_tiers(specs), id_maps(src_env, specs)
    parts = []
    for spec in load_order(specs):
        if spec.resolve_only or not spec.key or spec.name not in diff.tables:
            continue
        found = diff.rows.where(F.col("table") == spec.name)
        rows = extract_delta(scan(src_env, spec, (fields or {}).get(spec.name, ())), found, spec.id_col)
        parts += resolved_parts(rows, spec, tiers[spec.name][0], maps, "_delta", "new and modified rows")
    return write_bundle(path, fmt, "delta", parts, by_name(specs))
