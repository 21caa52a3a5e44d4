"""Carrying ids and keys of the source over to those the target gave out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.functions import exact_bytes, has_key, is_blank, looks_like_id
from tabsync.functions.text import ID_PATTERN
from tabsync.operators.clean import last_per_key
from tabsync.operators.lookup import Lookup, look_up
from tabsync.spec import Ref, TableSpec
from tabsync.storage import small_frame

XWALK_SCHEMA = "table string, source_id string, target_id string"
KEY_XWALK_SCHEMA = "table string, key_field string, source_key string, target_key string"


def _lookups(refs: Mapping[str, Ref], values: Mapping[str, Column], xwalk: DataFrame, kind: str) -> tuple[list[Lookup], dict[str, Column]]:
    """One lookup per column and parent table, and the first hit of each column in the order of its parents.

    Tables number their rows alone, so an id may mean a row of each parent; a row never meets more than one pair.
    """
    lookups, hits = [], {}
    for c, r in refs.items():
        for j, parent in enumerate(r.to):
            pairs = (xwalk.where(F.col("table") == parent).groupBy(f"source_{kind}").agg(F.max(f"target_{kind}").alias(f"target_{kind}")))
            lookups.append(Lookup(values[c], pairs, f"_new_{c}_{j}"))
        hits[c] = F.coalesce(*[F.col(f"_new_{c}_{j}") for j in range(len(r.to))])
    return lookups, hits


def rewrite_keys(df: DataFrame, spec: TableSpec, key_xwalk: DataFrame) -> DataFrame:
    """Translate relationship keys; a key that was not renumbered stays as it is."""
    refs = {r.key_col: r for r in spec.refs if r.key_col in df.columns}
    if not refs:
        return df
    lookups, hits = _lookups(refs, {c: F.col(c) for c in refs}, key_xwalk, "key")
    found = look_up(df, lookups)
    return found.select(*[F.coalesce(hits[c], F.col(c)).alias(c) if c in refs else F.col(c) for c in df.columns])


def _raw_refs(df: DataFrame, spec: TableSpec) -> list[Ref]:
    return [r for r in spec.refs if r.col in df.columns]


def _pending(df: DataFrame, ref: Ref, pattern: str | None):
    """The raw id still has to be translated: it is id-shaped and its relationship key is blank."""
    shaped = looks_like_id(ref.col, pattern) if pattern else F.col(ref.col).isNotNull()
    return shaped & is_blank(ref.key_col) if ref.key_col in df.columns else shaped


def mark_raw_refs(df: DataFrame, spec: TableSpec, xwalk: DataFrame,
                  pattern: str | None = ID_PATTERN) -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """Replace source ids by target ids; an id-shaped value without a hit becomes null.

    The second result names, for each reference column, the added columns that tell which rows had a hit and which a miss.
    ``pattern=None`` takes every value for an id, which suits numeric ids.
    """
    pending = {r.col: _pending(df, r, pattern) for r in _raw_refs(df, spec)}
    if not pending:
        return df, {}
    refs = {r.col: r for r in _raw_refs(df, spec)}
    lookups, hits = _lookups(refs, {c: F.when(pending[c], F.col(c)) for c in refs}, xwalk, "id")
    found = look_up(df, lookups)
    marks = {c: (f"__hit{i}", f"__miss{i}") for i, c in enumerate(refs)}
    return found.select(
        *[F.when(pending[c], hits[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
          if c in pending else F.col(c) for c in df.columns],
        *[m.alias(n) for c, names in marks.items() for n, m in zip(names, (
            F.coalesce(pending[c], F.lit(False)) & hits[c].isNotNull(), F.coalesce(pending[c], F.lit(False)) & hits[c].isNull()), strict=True)]), marks


def resolve_raw_refs(df: DataFrame, spec: TableSpec, xwalk: DataFrame,
                     pattern: str | None = ID_PATTERN) -> DataFrame:
    """The rows of :func:`mark_raw_refs` alone."""
    out, marks = mark_raw_refs(df, spec, xwalk, pattern)
    return out.drop(*[n for names in marks.values() for n in names])


def resolved_columns(before: DataFrame, spec: TableSpec, xwalk: DataFrame,
                     pattern: str | None = ID_PATTERN) -> set[str]:
    """Reference columns in which at least one source id has a target id (one aggregate, run now)."""
    refs = _raw_refs(before, spec)
    if not refs:
        return set()
    values = F.array_compact(F.array(*[
        F.when(_pending(before, r, pattern), F.struct(F.lit(r.col).alias("field"),
                                                      F.col(r.col).cast("string").alias("value")))
        for r in refs]))
    used = before.select(F.explode(values).alias("v")).select("v.field", "v.value").distinct()
    targets = {r.col: r.to for r in refs}
    fits = None
    for col, tables in targets.items():
        test = (F.col("field") == col) & F.col("table").isin(*tables)
        fits = test if fits is None else fits | test
    hits = used.join(xwalk, (F.col("value") == F.col("source_id")) & fits, "left_semi")
    return {r.field for r in hits.select("field").distinct().collect()}


def map_to_target_ids(df: DataFrame, target: DataFrame, key: str, id_col: str,
                      key_xwalk: DataFrame | None = None, order_cols: Sequence[str] = ()) -> DataFrame:
    """Find target ids for a key that cannot be written: by key, else by translated key.

    The id comes first, the key column goes away and ``op`` says update or insert. ``key_xwalk``
    holds (source_key, target_key) of this table.
    """
    kind = target.schema[id_col].dataType
    held = last_per_key(target.where(has_key(key, target)), key, order_cols or (id_col,)).select(
        F.col(key).cast("string").alias("_key"), F.col(id_col).alias("_direct"))
    rest = [c for c in df.columns if c not in (key, id_col)]
    lookups = [Lookup(F.col("_own"), held, "_direct")]
    if key_xwalk is not None:
        # Repeated source keys have several target rows; one of them is taken, so that no row is doubled.
        moved = (key_xwalk.select("source_key", "target_key").join(held, F.col("target_key") == F.col("_key"))
                 .groupBy(F.col("source_key").alias("_from")).agg(F.max("_direct").alias("_moved")))
        lookups.append(Lookup(F.col("_own"), moved, "_moved"))
    found = F.coalesce(*[F.col(x.name) for x in lookups]).cast(kind)
    out = look_up(df.select(*rest, F.col(key).cast("string").alias("_own")), lookups)
    return out.select(found.alias(id_col), *rest, F.when(found.isNull(), "insert").otherwise("update").alias("op"))


def mark_repeated(df: DataFrame, id_col: str, order_cols: Sequence[str], key: str) -> DataFrame:
    """Add ``_repeated``: the error of rows that share a target id with a later row, else an empty list.

    ``order_cols`` tell the rows apart; where they tie, a hash of the row does. Rows without a target id are new and repeat nothing.
    """
    place = F.struct(*[F.col(c) for c in order_cols], F.xxhash64(*[F.col(c) for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]).alias("_tie"))
    marked = df.withColumn("_place", place)
    label = lambda c: F.hex(exact_bytes(F.col(c), marked.schema["_place"].dataType))
    last = marked.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_on")).agg(F.max("_place").alias("_place")).select("_on", label("_place").alias("_last"))
    marked = look_up(marked.withColumn("_place", label("_place")), [Lookup(F.col(id_col), last, "_last")])
    error = F.when(F.col("_place") != F.col("_last"), F.array(F.lit(f"DUPLICATE_VALUE:{key}"))).otherwise(F.array().cast("array<string>"))
    return marked.select(*[F.col(c) for c in df.columns], error.alias("_repeated"))


def match_by_name(src: DataFrame, tgt: DataFrame, name_col: str, src_id: str, tgt_id: str,
                  order_cols: Sequence[str] = ()) -> DataFrame:
    """(source_id, name, target_id): exact name match, target id null where there is none."""
    names = last_per_key(tgt.where(F.col(name_col).isNotNull()), name_col, order_cols or (tgt_id,)).select(
        F.col(name_col).alias("_name"), F.col(tgt_id).cast("string").alias("target_id"))
    own = src.select(F.col(src_id).cast("string").alias("source_id"), F.col(name_col).alias("name"))
    return look_up(own, [Lookup(F.col("name"), names, "target_id")])


def match_by_composite(src: DataFrame, tgt: DataFrame, cols: Sequence[str], src_id: str, tgt_id: str,
                       order_cols: Sequence[str] = ()) -> DataFrame:
    """Match rows on several columns, null equal to null.

    The columns may be parents' natural keys, brought in by resolving references on both sides.
    """
    kinds = src.select(*cols).union(tgt.select(*cols)).schema  # what values of either side compare as
    # Nulls are told from empty texts, then the values by their bytes.
    label = F.hex(F.concat(*[x for f in kinds.fields for x in (F.col(f.name).isNull().cast("string").cast("binary"),
                                                              exact_bytes(F.col(f.name).cast(f.dataType), f.dataType))]))
    held = last_per_key(tgt, cols, order_cols or (tgt_id,)).select(label.alias("_label"), F.col(tgt_id).cast("string").alias("_target"))
    own = src.select(F.col(src_id).cast("string").alias("source_id"), *cols, label.alias("_label"))
    return look_up(own, [Lookup(F.col("_label"), held, "target_id")]).drop("_label")


def id_xwalk(loaded: DataFrame, table: str) -> DataFrame:
    """(table, source_id, target_id) of the loaded rows whose id changed."""
    ids = loaded.select(F.lit(table).alias("table"), F.col("source_id").cast("string").alias("source_id"),
                        F.col("target_id").cast("string").alias("target_id"))
    return ids.where(F.col("source_id") != F.col("target_id"))


def key_xwalk(loaded: DataFrame, table: str, key_field: str) -> DataFrame:
    """(table, key_field, source_key, target_key) of the loaded rows whose key changed."""
    keys = loaded.select(F.lit(table).alias("table"), F.lit(key_field).alias("key_field"),
                         F.col("source_key").cast("string").alias("source_key"),
                         F.col("target_key").cast("string").alias("target_key"))
    return keys.where(has_key("source_key") & has_key("target_key")
                      & (F.col("source_key") != F.col("target_key")))


def empty_xwalk(spark) -> DataFrame:
    return small_frame(spark, [], XWALK_SCHEMA)


def empty_key_xwalk(spark) -> DataFrame:
    return small_frame(spark, [], KEY_XWALK_SCHEMA)
