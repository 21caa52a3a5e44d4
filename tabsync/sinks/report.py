"""Previews for people: what is there, what would be moved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsync.sources.catalog import row_counts
from tabsync.spec import Env, TableSpec, load_order, table_tiers


def _facts(df: DataFrame, values: dict[str, dict], names: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Attach facts known per table as literal columns."""
    for name, kind in zip(names, kinds):
        cases = [F.when(F.col("table") == t, F.lit(v[name])) for t, v in values.items()]
        df = df.withColumn(name, F.coalesce(*cases).cast(kind) if cases else F.lit(None).cast(kind))
    return df


def plan_report(env: Env, specs: Sequence[TableSpec]) -> DataFrame:
    """(order, tier, table, records, key): tables in load order, with a TOTAL line at the end.

    Tables that only resolve references are not moved and do not appear.
    """
    moved = [s for s in load_order(specs) if not s.resolve_only]
    tiers = table_tiers(specs)
    facts = {s.name: {"order": i + 1, "tier": tiers[s.name][0],
                      "key": s.key or ("(composite key)" if s.composite_key else None)}
             for i, s in enumerate(moved)}
    lines = _facts(row_counts(env, moved), facts, ("order", "tier", "key"), ("int", "int", "string"))
    total = lines.agg(F.sum("records").cast("bigint").alias("records")).select(
        F.lit(None).cast("int").alias("order"), F.lit(None).cast("int").alias("tier"), F.lit("TOTAL").alias("table"),
        "records", F.lit(None).cast("string").alias("key"))
    return lines.select("order", "tier", "table", "records", "key").unionByName(total).orderBy(
        F.col("order").asc_nulls_last())


def discovery_report(env: Env, specs: Sequence[TableSpec], min_records: int = 0) -> DataFrame:
    """(tier, table, records, keys, references, self_references, in_cycle, gap) by tier and name."""
    tiers = table_tiers(specs)
    referenced = {p: sorted({s.name for s in specs if any(p in r.to for r in s.parent_refs)})
                  for p in tiers}
    facts = {}
    for s in specs:
        gap = None
        if not s.key and referenced[s.name]:
            gap = f"Referenced by {len(referenced[s.name])} table(s) but has no key"
        elif not s.key and s.self_references:
            gap = "Has self reference(s) but no key"
        facts[s.name] = {"tier": tiers[s.name][0], "keys": s.key, "references": len(s.parent_refs),
                         "self_references": len(s.self_references), "in_cycle": tiers[s.name][1], "gap": gap}
    counts = row_counts(env, [s.name for s in specs]).where(F.col("records") >= min_records)
    names = ("tier", "keys", "references", "self_references", "in_cycle", "gap")
    lines = _facts(counts, facts, names, ("int", "string", "int", "int", "boolean", "string"))
    return lines.select("tier", "table", "records", *names[1:]).orderBy("tier", "table")
