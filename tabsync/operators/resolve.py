"""Local ids to portable business keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsync.functions import has_key
from tabsync.operators.lookup import Lookup, look_up
from tabsync.spec import Env, Ref, TableSpec


def id_map(env: Env, spec: TableSpec, filtered: bool = True) -> DataFrame:
    """(id, key) of the rows with a usable key.

    With ``filtered`` the table's own row filter applies, so references to rows outside it stay
    unresolved.
    """
    df = env[spec.name]
    if filtered and spec.filter:
        df = df.where(spec.filter)
    return (df.where(has_key(spec.key, df))
            .select(F.col(spec.id_col).alias("id"), F.col(spec.key).cast("string").alias("key")))


def id_maps(env: Env, specs: Sequence[TableSpec], filtered: bool = True) -> dict[str, DataFrame]:
    """One map per table that has a key and is present."""
    return {s.name: id_map(env, s, filtered) for s in specs if s.key and s.name in env}


def _hits(refs: Sequence[Ref], maps: Mapping[str, DataFrame]) -> tuple[list[Lookup], dict[str, list[tuple[str, str]]]]:
    """Lookups of each reference in the maps of its targets, and per column (target, name of the result) in the order of the targets."""
    names = {r.col: [(t, f"_k{i}_{j}") for j, t in enumerate(r.to) if t in maps] for i, r in enumerate(refs)}
    return [Lookup(F.col(c), maps[t], name) for c, found in names.items() for t, name in found], names


def resolve_references(df: DataFrame, spec: TableSpec, maps: Mapping[str, DataFrame],
                       keep_source_id: bool = True) -> DataFrame:
    """Add ``<relationship>__key`` for each reference and blank the ids that were resolved.

    A value without a hit stays in its own column. References to the table itself are dropped
    here and come back in :func:`self_ref_pass2`; so are values of a reference with several targets whose first hit is in the table itself.
    """
    df = df.drop(*[r.col for r in spec.refs if spec.is_self(r)])
    refs = [r for r in spec.parent_refs if r.col in df.columns]
    own_rows = spec.key and spec.self_refs != "skip"
    columns = df.columns
    lookups, names = _hits(refs, maps if own_rows else {t: m for t, m in maps.items() if t != spec.name})
    df = look_up(df, lookups)
    none = F.lit(None).cast("string")
    found, keys = {}, {}
    for r in refs:
        found[r.col] = F.coalesce(*[name for _, name in names[r.col]]) if names[r.col] else none
        key = none  # from the last target to the first: the first hit counts
        for target, name in reversed(names[r.col]):
            key = F.when(F.col(name).isNotNull(), none if target == spec.name else F.col(name)).otherwise(key)
        keys[r.col] = key
    plain = [F.when(found[c].isNull(), F.col(c)).alias(c) if c in found else F.col(c) for c in columns]
    source = [F.col(spec.id_col).alias("_source_id")] if keep_source_id and spec.id_col in columns else []
    return df.select(*plain, *[keys[r.col].alias(r.key_col) for r in refs], *source)


def unresolved_references(resolved: DataFrame, spec: TableSpec) -> DataFrame:
    """(field, value, n): reference values that found no parent, with their number of rows."""
    refs = [r for r in spec.parent_refs if r.col in resolved.columns and r.key_col in resolved.columns]
    misses = F.array_compact(F.array(*[
        F.when(F.col(r.col).isNotNull() & F.col(r.key_col).isNull(),
               F.struct(F.lit(r.col).alias("field"), F.col(r.col).cast("string").alias("value")))
        for r in refs]))
    return (resolved.select(F.explode(misses).alias("m")).groupBy("m.field", "m.value")
            .agg(F.count(F.lit(1)).alias("n")))


def self_ref_pass2(df: DataFrame, spec: TableSpec, own_map: DataFrame, maps: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Per reference to the table itself: (key, parent key) of the rows in which both are known.

    Where a reference has several targets, values that an earlier target of ``maps`` knows are not among them.
    """
    if not spec.key or spec.self_refs == "skip":
        return {}
    return {ref.col: _parent_keys(df, spec, ref, {**(maps or {}), spec.name: own_map}) for ref in spec.self_references
            if ref.col in df.columns}


def _parent_keys(df: DataFrame, spec: TableSpec, ref: Ref, maps: Mapping[str, DataFrame]) -> DataFrame:
    rows = df.where(has_key(spec.key, df) & F.col(ref.col).isNotNull()).select(spec.key, ref.col)
    first = Ref(ref.col, ref.to[:ref.to.index(spec.name) + 1], ref.rel)
    lookups, names = _hits([first], maps)
    *earlier, (_, own) = names[ref.col]
    own_only = F.col(own).isNotNull()
    for _, name in earlier:
        own_only = own_only & F.col(name).isNull()
    return look_up(rows, lookups).where(own_only).select(spec.key, F.col(own).alias(ref.key_col))


def order_columns(df: DataFrame, key: str | None) -> DataFrame:
    """Key first, the other columns by name."""
    rest = sorted(c for c in df.columns if c != key)
    return df.select(*([key] if key in df.columns else []), *rest)
