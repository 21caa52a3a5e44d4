"""Looking before moving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabsync.operators.graph import fk_edges
from tabsync.sinks.report import discovery_report, plan_report
from tabsync.sources.catalog import column_inventory, usable_table_names
from tabsync.spec import Env, FieldMeta, Ref, TableSpec


def specs_from_fields(fields: Sequence[FieldMeta], id_cols: dict[str, str]) -> list[TableSpec]:
    """Table specs as far as column flags tell them; the first key column is taken."""
    out = []
    for table in dict.fromkeys(f.table for f in fields):
        mine = [f for f in fields if f.table == table]
        key = next((f for f in mine if f.is_key), None)
        out.append(TableSpec(table, id_cols[table], key.name if key else None,
                             refs=tuple(Ref(f.name, f.reference_to, f.relationship) for f in mine if f.is_reference),
                             auto_number_key=bool(key and key.auto_number)))
    return out


def discover(env: Env, specs: Sequence[TableSpec], prefixes: Sequence[str] = (),
             min_records: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, columns, reference edges) of the tables whose names match."""
    names = set(usable_table_names([s.name for s in specs if s.name in env], prefixes))
    chosen = [s for s in specs if s.name in names]
    frames = {s.name: env[s.name] for s in chosen}
    fields = column_inventory(next(iter(env.values())).sparkSession, frames, chosen)
    edges, _ = fk_edges(fields, sorted(names))
    return discovery_report(frames, chosen, min_records), fields, edges


def plan(env: Env, specs: Sequence[TableSpec]) -> DataFrame:
    """What an export would move, in load order."""
    return plan_report(env, specs)
