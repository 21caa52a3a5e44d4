"""Source environment to bundle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tabsync.operators.resolve import id_maps, order_columns, resolve_references, self_ref_pass2
from tabsync.operators.subset import subset
from tabsync.sinks.bundle import (MANIFEST_SCHEMA, build_manifest, manifest_entry, read_table, table_path,
                                  write_table)
from tabsync.sources.tables import scan
from tabsync.spec import Env, FieldMeta, TableSpec, by_name, load_order, table_tiers
from tabsync.storage import side_by_side, small_frame


@dataclass
class Bundle:
    """Where an export was written and what it consists of."""

    path: str
    fmt: str
    entries: list[tuple[tuple, int]] = field(default_factory=list)

    def manifest(self, spark: SparkSession) -> DataFrame:
        return build_manifest(spark, self.entries)

    @property
    def total_rows(self) -> int:
        return sum(n for _, n in self.entries)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Bundle:
        """Read a bundle's manifest: one line per written table."""
        lines = spark.read.json(f"{path}/_manifest", schema=f"fmt string, {MANIFEST_SCHEMA}")
        rows = lines.orderBy("tier", "order").collect()
        entries = [((r.mode, r.tier, r.order, r.path, r.table, r.key_field, r.operation, r.pass2, r.notes), r.rows)
                   for r in rows]
        return cls(path, rows[0].fmt if rows else "parquet", entries)


def headers(spec: TableSpec, specs: Mapping[str, TableSpec]) -> dict[str, str]:
    """Dotted CSV headers of the relationship keys."""
    out = {}
    for ref in spec.refs:
        parent = specs.get(ref.to[0])
        out[ref.key_col] = f"{ref.relationship}.{parent.key if parent and parent.key else 'key'}"
    return out


@dataclass
class Part:
    """One folder of a bundle before it is written."""

    spec: TableSpec
    tier: int
    df: DataFrame
    suffix: str = ""
    pass2: bool = False
    notes: str | None = None


def write_bundle(path: str, fmt: str, mode: str, parts: Sequence[Part], specs: Mapping[str, TableSpec]) -> Bundle:
    """Write the parts, which are independent of each other, and the manifest.

    Row counts come from the writes. Empty parts stay out of the manifest.
    """
    spark, bundle, work, lines = parts[0].df.sparkSession, Bundle(path, fmt), [], []
    for order, p in enumerate(parts, 1):
        where = table_path(p.tier, order, p.spec.name, p.suffix)
        lines.append(manifest_entry(mode, p.tier, order, where, p.spec, p.pass2, p.notes))
        work.append(partial(write_table, p.df, f"{path}/{where}", fmt, headers(p.spec, specs)))
    bundle.entries = [(line, rows) for line, rows in zip(lines, side_by_side(spark, work)) if rows]
    small_frame(spark, [(fmt, *e[:6], n, *e[6:]) for e, n in bundle.entries],
                f"fmt string, {MANIFEST_SCHEMA}").coalesce(1).write.json(f"{path}/_manifest")
    return bundle


def resolved_parts(rows: DataFrame, spec: TableSpec, tier: int, maps: Mapping[str, DataFrame], suffix: str = "",
                   notes: str | None = None) -> list[Part]:
    """A table with references as business keys, and its self references as parts of their own."""
    main = order_columns(resolve_references(rows, spec, maps), spec.key)
    own = self_ref_pass2(rows, spec, maps[spec.name], maps) if spec.key else {}
    return [Part(spec, tier, main, suffix, False, notes),
            *[Part(spec, tier, pairs, f"{suffix}_pass2_{col}", True, "load after the table itself")
              for col, pairs in own.items()]]


def export(env: Env, specs: Sequence[TableSpec], path: str, root: str | None = None, values=None,
           match_by: str = "name", fmt: str = "parquet",
           fields: Mapping[str, Sequence[FieldMeta]] | None = None,
           default_exclude: Sequence[str] = ()) -> Bundle:
    """Write each table in load order with references as business keys, self references last.

    With ``root`` and ``values`` only the rows related to those root rows are moved.
    """
    if root is not None:
        env = subset(env, specs, root, values, match_by)
    specs = [s for s in specs if s.name in env]
    tiers, maps = table_tiers(specs), id_maps(env, specs)
    parts = []
    for spec in load_order(specs):
        if not spec.resolve_only:
            rows = scan(env, spec, (fields or {}).get(spec.name, ()), default_exclude)
            parts += resolved_parts(rows, spec, tiers[spec.name][0], maps)
    return write_bundle(path, fmt, "full", parts, by_name(specs))


def read_bundle_table(spark: SparkSession, bundle: Bundle, path: str, spec: TableSpec,
                      specs: Mapping[str, TableSpec]) -> DataFrame:
    return read_table(spark, f"{bundle.path}/{path}", bundle.fmt, headers(spec, specs))
