"""Comparing two snapshots of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.functions import change_list, comparable, differs, display_name, fingerprint_label, has_key
from tabsync.operators.clean import last_per_key
from tabsync.sources.tables import scan
from tabsync.spec import Env, FieldMeta, TableSpec
from tabsync.storage import materialise_counted, side_by_side, small_frame

# Columns that never take part in a comparison, and the usual name columns.
SYSTEM_COLUMNS = frozenset({"Id", "IsDeleted", "CreatedDate", "CreatedById", "LastModifiedDate",
                            "LastModifiedById", "SystemModstamp", "OwnerId", "attributes"})
NAME_COLUMNS = ("Name", "SBQQ__RuleName__c", "DeveloperName")

COUNTERS = ("source", "target", "new", "modified", "deleted", "identical", "duplicate_keys", "blank_keys")


def compare_columns(src: DataFrame, tgt: DataFrame, spec: TableSpec) -> list[str]:
    """Columns of both sides, in source order, that carry comparable content."""
    ignored = SYSTEM_COLUMNS | {spec.id_col} | set(spec.compare_ignore) | {r.col for r in spec.refs}
    if spec.auto_number_key and spec.key:
        ignored |= {spec.key}
    return [c for c in src.columns if c in tgt.columns and c not in ignored]


def _names(df: DataFrame, spec: TableSpec) -> list[str]:
    wanted = (spec.name_col,) if spec.name_col else NAME_COLUMNS
    return [c for c in wanted if c in df.columns]


def _side(df: DataFrame, spec: TableSpec, content: Column, label: str, as_text: bool) -> DataFrame:
    """One row per usable key, packed into a struct named ``label``; the last row of a key wins.

    The key gets its final type first, so that the join can use the partitioning of the reduction,
    and only what the comparison needs is kept.
    """
    key = F.col(spec.key).cast("string") if as_text else F.col(spec.key)
    keyed = df.where(has_key(spec.key, df)).select(
        key.alias("_key"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(spec.ordering())],
        F.col(spec.id_col).cast("string").alias("_id"), display_name(_names(df, spec)).alias("_name"), content.alias("_v"))
    return last_per_key(keyed, "_key", [f"_o{i}" for i in range(len(spec.ordering()))]).select(
        F.col("_key").alias("key"),
        F.struct(F.col("_id").alias("id"), F.col("_name").alias("name"), F.col("_v").alias("v")).alias(label))


def _contents(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols]) if cols else F.lit(True)


def join_snapshots(src: DataFrame, tgt: DataFrame, spec: TableSpec, cols: Sequence[str] | None = None) -> DataFrame:
    """(key, s, t, status) for every key of either side; ``s`` and ``t`` are null when absent.

    Both sides are reduced to one row per key before they move, then meet in a full join that
    needs no further shuffle because the reduction is already partitioned by key.
    """
    cols = compare_columns(src, tgt, spec) if cols is None else list(cols)
    changed = F.lit(False)
    for c in cols:
        changed = changed | differs(F.col(f"s.v.{c}"), F.col(f"t.v.{c}"),
                                    src.schema[c].dataType, tgt.schema[c].dataType)
    return _meet(src, tgt, spec, _contents(src, cols), _contents(tgt, cols), changed)


def _meet(src: DataFrame, tgt: DataFrame, spec: TableSpec, source: Column, target: Column, changed: Column) -> DataFrame:
    as_text = src.schema[spec.key].dataType != tgt.schema[spec.key].dataType
    joined = _side(src, spec, source, "s", as_text).join(_side(tgt, spec, target, "t", as_text), "key", "full")
    status = (F.when(F.col("t").isNull(), "new").when(F.col("s").isNull(), "deleted")
              .when(changed, "modified").otherwise("identical"))
    return joined.select(F.col("key").cast("string").alias("key"), "s", "t", status.alias("status"))


def join_digests(src: DataFrame, tgt: DataFrame, spec: TableSpec, cols: Sequence[str]) -> DataFrame:
    """Like :func:`join_snapshots`, but rows travel as a hash of their content.

    Tells that a row changed, not how. Both sides must have the same column types.
    """
    changed = F.col("s.v") != F.col("t.v")
    return _meet(src, tgt, spec, fingerprint_label(src, cols), fingerprint_label(tgt, cols), changed)


def _digestible(src: DataFrame, tgt: DataFrame, cols: Sequence[str]) -> bool:
    """Hashes tell the same as values if both sides have the same types, and texts compare by their bytes."""
    kinds = [(src.schema[c].dataType, tgt.schema[c].dataType) for c in cols]
    return bool(cols) and all(a == b and "COLLATE" not in a.simpleString().upper() for a, b in kinds)


def diff_rows(joined: DataFrame, table: str) -> DataFrame:
    """(table, status, strategy, key, source_id, target_id, name)."""
    return joined.select(F.lit(table).alias("table"), "status", F.lit("key").alias("strategy"), "key",
                         F.col("s.id").alias("source_id"), F.col("t.id").alias("target_id"),
                         F.coalesce("s.name", "t.name").alias("name"))


def diff_by_key(src: DataFrame, tgt: DataFrame, spec: TableSpec, cols: Sequence[str] | None = None,
                digest: bool = False) -> DataFrame:
    """Status of every key. With ``digest``, contents are compared by hash where both sides have the same types, so
    that a row costs a key and 64 characters in the shuffle however long it is; the answer is the same."""
    cols = compare_columns(src, tgt, spec) if cols is None else list(cols)
    if digest and _digestible(src, tgt, cols):
        return diff_rows(join_digests(src, tgt, spec, cols), spec.name)
    return diff_rows(join_snapshots(src, tgt, spec, cols), spec.name)


def changes_of(rows: DataFrame, src: DataFrame, tgt: DataFrame, spec: TableSpec) -> DataFrame:
    """Changed fields of the rows that a diff found modified; only those rows are joined again."""
    modified = rows.where(F.col("status") == "modified")

    def only(df: DataFrame, side: str) -> DataFrame:
        ids = modified.select(F.col(side).alias("_wanted"))
        return df.join(ids, F.col(spec.id_col).cast("string") == F.col("_wanted"), "left_semi")

    return diff_changes(join_snapshots(only(src, "source_id"), only(tgt, "target_id"), spec), spec.name)


def diff_changes(joined: DataFrame, table: str) -> DataFrame:
    """(table, key, field, source_value, target_value), one row per changed field."""
    source_kinds = {f.name: f.dataType for f in joined.schema["s"].dataType["v"].dataType.fields}
    target_kinds = {f.name: f.dataType for f in joined.schema["t"].dataType["v"].dataType.fields}
    fields = [(c, F.col(f"s.v.{c}"), F.col(f"t.v.{c}"), k, target_kinds[c]) for c, k in source_kinds.items()]
    return (joined.where(F.col("status") == "modified").select("key", F.explode(change_list(fields)).alias("c"))
            .select(F.lit(table).alias("table"), "key", "c.field", "c.source_value", "c.target_value"))


def diff_summary(rows: DataFrame, src: DataFrame, tgt: DataFrame, spec: TableSpec) -> DataFrame:
    """One line of counts. In a key diff, source and target count distinct usable keys.

    Blank and repeated keys are counted in a scan of the key columns alone; only single rows of
    partial counts move.
    """
    statuses = ("new", "modified", "deleted", "identical")
    zero = F.lit(0).cast("bigint")
    parts = [rows.agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])
             .select(*statuses, zero.alias("usable"), zero.alias("blank_keys"))]
    by_key = not spec.auto_number_key
    for df in (src, tgt) if by_key else ():
        parts.append(df.agg(F.count_if(has_key(spec.key, df)).alias("usable"),
                            F.count_if(~has_key(spec.key, df)).alias("blank_keys"))
                     .select(*[zero.alias(s) for s in statuses], "usable", "blank_keys"))
    line = reduce(DataFrame.unionByName, parts).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in (*statuses, "usable", "blank_keys")])
    source = F.col("new") + F.col("modified") + F.col("identical")
    target = F.col("deleted") + F.col("modified") + F.col("identical")
    duplicates = F.col("usable") - source - target if by_key else zero
    return line.select(F.lit(spec.name).alias("table"), F.lit("key" if by_key else "fingerprint").alias("strategy"),
                       source.alias("source"), target.alias("target"), *statuses,
                       duplicates.alias("duplicate_keys"), "blank_keys")


STATUSES = ("new", "modified", "deleted", "identical")


def counted_snapshots(src: DataFrame, tgt: DataFrame, spec: TableSpec, cols: Sequence[str] | None = None) -> DataFrame:
    """Like :func:`join_snapshots`, with the number of rows that each side has under a key (``n_s``, ``n_t``).

    Rows without a usable key are one more row for each side, with a null key. A side is read once and reduced by an
    aggregate before it moves, so that nothing has to be counted in a scan of its own.
    """
    cols = compare_columns(src, tgt, spec) if cols is None else list(cols)
    as_text = src.schema[spec.key].dataType != tgt.schema[spec.key].dataType

    def side(df: DataFrame, label: str) -> DataFrame:
        key = F.col(spec.key).cast("string") if as_text else F.col(spec.key)
        row = F.struct(F.col(spec.id_col).cast("string").alias("id"), display_name(_names(df, spec)).alias("name"), _contents(df, cols).alias("v"))
        keyed = df.select(F.when(has_key(spec.key, df), key).alias("key"), row.alias("r"), F.struct(*[F.col(c) for c in spec.ordering()]).alias("o"))
        return keyed.groupBy("key").agg(F.max_by("r", "o").alias(label), F.count(F.lit(1)).alias(f"n_{label}"))

    changed = F.lit(False)
    for c in cols:
        changed = changed | differs(F.col(f"s.v.{c}"), F.col(f"t.v.{c}"), src.schema[c].dataType, tgt.schema[c].dataType)
    status = (F.when(F.col("n_t").isNull(), "new").when(F.col("n_s").isNull(), "deleted").when(changed, "modified").otherwise("identical"))
    joined = side(src, "s").join(side(tgt, "t"), "key", "full")
    return joined.select(F.col("key").cast("string").alias("key"), "s", "t", status.alias("status"), "n_s", "n_t")


def _key_counters() -> dict[str, Column]:
    """What :func:`diff_summary` counts, as aggregates over :func:`counted_snapshots`."""
    usable = F.col("key").isNotNull()
    rows = F.coalesce("n_s", F.lit(0)) + F.coalesce("n_t", F.lit(0))
    sides = F.when(F.col("n_s").isNotNull(), 1).otherwise(0) + F.when(F.col("n_t").isNotNull(), 1).otherwise(0)
    return {**{s: F.count_if(usable & (F.col("status") == s)) for s in STATUSES},
            "duplicate_keys": F.coalesce(F.sum(F.when(usable, rows - sides)), F.lit(0)).cast("bigint"),
            "blank_keys": F.coalesce(F.sum(F.when(~usable, rows)), F.lit(0)).cast("bigint")}


def _line(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The line of a summary from its counters; source and target count distinct usable keys, or all rows without a key."""
    source = F.col("new") + F.col("modified") + F.col("identical")
    target = F.col("deleted") + F.col("modified") + F.col("identical")
    return df.select(F.lit(spec.name).alias("table"), F.lit("fingerprint" if spec.auto_number_key else "key").alias("strategy"),
                     source.alias("source"), target.alias("target"), *STATUSES, "duplicate_keys", "blank_keys")


def diff_counts(src: DataFrame, tgt: DataFrame, spec: TableSpec, cols: Sequence[str] | None = None) -> DataFrame:
    """The line of :func:`diff_summary` without the rows: each side is read once, and no row is ranked to be counted."""
    if not spec.auto_number_key:
        return _line(counted_snapshots(src, tgt, spec, cols).agg(*[c.alias(n) for n, c in _key_counters().items()]), spec)
    cols = sorted(compare_columns(src, tgt, spec) if cols is None else cols)
    sides = [df.select(fingerprint_label(df, cols).alias("label"), F.lit(s).alias("s"), F.lit(t).alias("t")) for df, s, t in ((src, 1, 0), (tgt, 0, 1))]
    groups = sides[0].union(sides[1]).groupBy("label").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    zero = F.lit(0).cast("bigint")
    total = lambda c: F.coalesce(F.sum(c), zero).cast("bigint")
    return _line(groups.agg(total(F.greatest(F.col("s") - F.col("t"), zero)).alias("new"), zero.alias("modified"),
                            total(F.greatest(F.col("t") - F.col("s"), zero)).alias("deleted"), total(F.least("s", "t")).alias("identical"),
                            zero.alias("duplicate_keys"), zero.alias("blank_keys")), spec)


def counted_diff(src: DataFrame, tgt: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(diff rows, written; the line of the summary), which is counted while the rows are written."""
    spark = src.sparkSession
    if spec.auto_number_key:
        found, seen = materialise_counted(diff_by_fingerprint(src, tgt, spec), f"diff-{spec.name}",
                                          **{s: F.count_if(F.col("status") == s) for s in STATUSES})
        counts = [seen[s] for s in STATUSES] + [0, 0]
    else:
        joined = counted_snapshots(src, tgt, spec)
        named = diff_rows(joined, spec.name).columns
        rows = joined.select(F.lit(spec.name).alias("table"), "status", F.lit("key").alias("strategy"), "key", F.col("s.id").alias("source_id"),
                             F.col("t.id").alias("target_id"), F.coalesce("s.name", "t.name").alias("name"), "n_s", "n_t")
        found, seen = materialise_counted(rows, f"diff-{spec.name}", drop=("n_s", "n_t"), **_key_counters())
        found = found.where(F.col("key").isNotNull()).select(*named)  # at most one line a side has none
        counts = [seen[c] for c in (*STATUSES, "duplicate_keys", "blank_keys")]
    kinds = ", ".join(f"{c} bigint" for c in (*STATUSES, "duplicate_keys", "blank_keys"))
    return found, _line(small_frame(spark, [tuple(counts)], kinds), spec)


def with_total(summary: DataFrame) -> DataFrame:
    """Add the TOTAL line; with ``rollup`` both levels come out of one pass."""
    out = summary.rollup("table").agg(F.max("strategy").alias("strategy"), F.grouping("table").alias("_total"),
                                      *[F.sum(c).cast("bigint").alias(c) for c in COUNTERS])
    total = F.col("_total") == 1
    return out.select(F.when(total, "TOTAL").otherwise(F.col("table")).alias("table"),
                      F.when(~total, F.col("strategy")).alias("strategy"), *COUNTERS)


def fingerprint_counts(src: DataFrame, tgt: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per distinct content: rows on each side and how many are identical, new, deleted.

    One shuffle over both sides; equal rows are counted before they move, so a content that makes
    up a large part of the table costs one row per task.
    """
    tagged = [df.select(*comparable(df, cols), F.lit(s).alias("_s"), F.lit(t).alias("_t"))
              for df, s, t in ((src, 1, 0), (tgt, 0, 1))]
    grouped = tagged[0].union(tagged[1]).groupBy(*cols).agg(
        F.sum("_s").cast("bigint").alias("source"), F.sum("_t").cast("bigint").alias("target"))
    zero = F.lit(0).cast("bigint")
    return grouped.select("*", F.least("source", "target").alias("identical"),
                          F.greatest(F.col("source") - F.col("target"), zero).alias("new"),
                          F.greatest(F.col("target") - F.col("source"), zero).alias("deleted"))


def fingerprint_summary(counts: DataFrame) -> DataFrame:
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                        for c in ("source", "target", "identical", "new", "deleted")])


def fingerprint_totals(src: DataFrame, tgt: DataFrame, cols: Sequence[str], groups: int = 256) -> DataFrame:
    """The line of :func:`fingerprint_summary` of :func:`fingerprint_counts`; rows move only where the sides differ. Runs now.

    Contents are dealt to groups by their SHA-256. Of a group each side is one line for each task: its rows, and the sums of four
    other parts of 32 bits of the hashes. Groups in which these agree hold the same contents as often, up to a collision of 128 bits; rows of the others
    are read again and counted whole.
    """
    kinds = src.select(*cols).union(tgt.select(*cols)).schema  # what values of either side compare as
    if not cols or "COLLATE" in kinds.simpleString().upper():
        return fingerprint_summary(fingerprint_counts(src, tgt, cols))
    sides = [df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields]) for df in (src, tgt)]
    sides = [df.withColumn("_h", fingerprint_label(df, cols)).withColumn("_g", _number("_h", 4) % groups) for df in sides]
    parts = [f"_p{i}" for i in range(4)]
    lines = [df.select("_g", F.lit(one).alias("_s"), *[(_number("_h", i) * one).alias(p) for i, p in enumerate(parts)])
             for df, one in zip(sides, (1, -1), strict=True)]
    counted = [df.groupBy("_g").agg(F.sum("_s").cast("bigint").alias("n"), *[F.sum(p).alias(p) for p in parts]) for df in lines]
    both = counted[0].unionByName(counted[1]).groupBy("_g").agg(
        F.sum(F.greatest("n", F.lit(0))).alias("source"), F.sum("n").alias("more"), *[F.sum(p).alias(p) for p in parts]).collect()  # a line a group
    apart = [r["_g"] for r in both if r["more"] or any(r[p] for p in parts)]
    same = sum(r["source"] for r in both if r["_g"] not in apart)
    agree = small_frame(src.sparkSession, [(same, same, same, 0, 0)], "source bigint, target bigint, identical bigint, new bigint, deleted bigint")
    if not apart:
        return agree
    rest = fingerprint_summary(fingerprint_counts(*[df.where(F.col("_g").isin(*apart)).select(*cols) for df in sides], cols))
    return agree.unionByName(rest).agg(*[F.sum(c).cast("bigint").alias(c) for c in agree.columns])


def _number(label: str, part: int) -> Column:
    """Eight hexadecimal digits of a hash as a whole number."""
    return F.conv(F.substring(label, 1 + 8 * part, 8), 16, 10).cast("bigint")


def surplus(src: DataFrame, tgt: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Multiset difference both ways: content, the side that has more of it, and how many more."""
    counts = fingerprint_counts(src, tgt, cols).where(F.col("source") != F.col("target"))
    more = F.col("source") > F.col("target")
    return counts.select(*cols, F.when(more, "new").otherwise("deleted").alias("status"),
                         F.abs(F.col("source") - F.col("target")).alias("copies"))


def rank_in_group(df: DataFrame, group: str, order_col: str, name: str = "rank", digits: int = 4) -> DataFrame:
    """Number from 1 of a row among the rows of its group, for groups of any size.

    Rows are ordered by (some hex digits of a hash, order column). Only rows that share group and
    digits meet in one window, and the sizes of the group's earlier buckets are added on top.
    """
    df = df.withColumn("_b", F.substring(F.md5(F.col(order_col).cast("string")), 1, digits))
    inside = Window.partitionBy(group, "_b").orderBy(order_col)
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (df.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
             .select(group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    ranked = df.withColumn("_r", F.row_number().over(inside)).join(sizes, [group, "_b"])
    return ranked.withColumn(name, (F.col("_r") + F.col("_before")).cast("bigint")).drop("_b", "_r", "_before")


def diff_by_fingerprint(src: DataFrame, tgt: DataFrame, spec: TableSpec, cols: Sequence[str] | None = None) -> DataFrame:
    """Row level diff without a usable key: equal contents are paired off, the rest is new or deleted.

    Which of several equal rows is the surplus one is decided by :func:`rank_in_group` on the id.
    Only (hash, id, name) moves. ``key`` holds the content hash.
    """
    cols = sorted(compare_columns(src, tgt, spec) if cols is None else cols)

    def side(df: DataFrame, label: str) -> DataFrame:
        narrow = df.select(fingerprint_label(df, cols).alias("key"), F.col(spec.id_col).alias("_id"),
                           display_name(_names(df, spec)).alias("_name"))
        return rank_in_group(narrow, "key", "_id").select("key", "rank", F.struct(
            F.col("_id").cast("string").alias("id"), F.col("_name").alias("name")).alias(label))

    pairs = side(src, "s").join(side(tgt, "t"), ["key", "rank"], "full")
    status = F.when(F.col("t").isNull(), "new").when(F.col("s").isNull(), "deleted").otherwise("identical")
    return pairs.select(F.lit(spec.name).alias("table"), status.alias("status"),
                        F.lit("fingerprint").alias("strategy"), "key", F.col("s.id").alias("source_id"),
                        F.col("t.id").alias("target_id"), F.coalesce("s.name", "t.name").alias("name"))


def extract_delta(src: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """Source rows that are new or modified, found by their own id."""
    wanted = rows.where(F.col("status").isin("new", "modified")).select(F.col("source_id").alias("_wanted"))
    return src.join(wanted, F.col(id_col).cast("string") == F.col("_wanted"), "left_semi")


@dataclass(frozen=True)
class Diff:
    """Comparison of whole environments; ``rows`` and ``changes`` cover all compared tables."""

    rows: DataFrame
    changes: DataFrame
    summary: DataFrame
    tables: tuple[str, ...]


def diff_all(src_env: Env, tgt_env: Env, specs: Sequence[TableSpec],
             fields: Mapping[str, Sequence[FieldMeta]] | None = None, keep: bool = True) -> Diff:
    """Compare each table that has a key and exists on both sides.

    Tables with an automatically numbered key are compared by content. With ``keep`` the diff rows
    of a table are written once and the summary is counted in passing; without, the summary reads each side once and ranks nothing.
    """
    names, sides = [], []
    for spec in specs:
        if not spec.key or spec.resolve_only or spec.name not in src_env or spec.name not in tgt_env:
            continue
        metas = (fields or {}).get(spec.name, ())
        sides.append((scan(src_env, spec, metas), scan(tgt_env, spec, metas), spec))
        names.append(spec.name)
    if not sides:
        raise ValueError("no table can be compared: each lacks a key or is missing on one side")
    spark = sides[0][0].sparkSession
    if keep:
        rows, lines = zip(*side_by_side(spark, [partial(counted_diff, *side) for side in sides]))
    else:
        rows = [(diff_by_fingerprint if spec.auto_number_key else diff_by_key)(src, tgt, spec) for src, tgt, spec in sides]
        lines = [diff_counts(*side) for side in sides]
    changes = [changes_of(r, src, tgt, spec) for r, (src, tgt, spec) in zip(rows, sides)
               if not spec.auto_number_key and compare_columns(src, tgt, spec)]
    if not changes:
        changes = [small_frame(spark, [], "table string, key string, field string, "
                                             "source_value string, target_value string")]
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    return Diff(union(rows), union(changes), union(lines), tuple(names))


