"""Preparing rows for a load: duplicates, columns, values, checks."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.functions import is_blank, is_email, mask_email, not_blank, trimmed
from tabsync.functions.text import needs_mask
from tabsync.operators.lookup import is_member
from tabsync.spec import FieldMeta, TableSpec
from tabsync.storage import materialise, small_frame

# Columns a load never writes, columns it always keeps, and the wording of
# transient errors.
NEVER_LOADED = frozenset({"OwnerId", "CreatedById", "LastModifiedById"})
ALWAYS_LOADED = frozenset({"CurrencyIsoCode"})
RETRYABLE_PATTERNS = (
    "CANNOT_INSERT_UPDATE_ACTIVATE_ENTITY",
    "UNABLE_TO_LOCK_ROW",
    "Row was retrieved via a query locker",
    "Too many retries of batch save",
)
TEXT_TYPES = frozenset({"string", "textarea"})


def last_per_key(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The last row of each key.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle too, so each
    task sends at most one row per key, however frequent the key is.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_keep_last(df: DataFrame, key: str | None, order_cols: Sequence[str], id_col: str = "Id") -> DataFrame:
    """Keep the last row per trimmed key; rows with a blank key are all kept.

    ``order_cols`` should order the rows totally. A table loaded by id is left alone.
    """
    if not key or key == id_col:
        return df
    keyed = df.where(not_blank(key)).withColumn("_key", trimmed(key))
    return last_per_key(keyed, "_key", order_cols).drop("_key").unionByName(df.where(is_blank(key)))


def duplicates_removed(df: DataFrame, key: str) -> DataFrame:
    """(table-wide) number of rows that :func:`dedupe_keep_last` drops."""
    per_key = df.where(not_blank(key)).groupBy(trimmed(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates_removed"))


def split_by_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, for upsert; rows without one and without the key column, for insert)."""
    return df.where(not_blank(key)), df.where(is_blank(key)).drop(key)


def classify_rejects(df: DataFrame, error_col: str = "error",
                     patterns: Sequence[str] = RETRYABLE_PATTERNS) -> DataFrame:
    """Add ``retryable``: the error text contains one of the patterns."""
    text = F.coalesce(F.col(error_col), F.lit(""))
    return df.withColumn("retryable", reduce(Column.__or__, [text.contains(p) for p in patterns]))


def union_results(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def route_by_membership(df: DataFrame, fk: str, ids: DataFrame,
                        xwalk: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows whose parent is in ``ids``, the rest); source ids that lead to a member count too.

    The marked rows are written once, as both parts are read.
    """
    members = ids.select(F.col(ids.columns[0]).cast("string").alias("_member"))
    if xwalk is not None:
        pairs = xwalk.select(F.col("source_id").alias("_source"), "target_id")
        members = members.unionByName(is_member(pairs, F.col("target_id"), members.distinct(), "_known").where("_known")
                                      .select(F.col("_source").alias("_member")))
    marked = materialise(is_member(df, F.col(fk), members.where(F.col("_member").isNotNull()).distinct(), "_in"), "routed")
    return marked.where("_in").drop("_in"), marked.where("NOT _in").drop("_in")


def email_candidates(df: DataFrame, fields: Sequence[FieldMeta] = (), skip: Collection[str] = ()) -> list[tuple[str, str, Column, Column]]:
    """(column, reason, non-blank values, addresses) for each text column that may hold addresses; the last two are aggregates."""
    types = {f.name: f.type for f in fields}
    out = []
    for field in df.schema.fields:
        c = field.name
        if "." in c or c in ("Id", "_source_id") or c in skip or not isinstance(field.dataType, T.StringType):
            continue
        declared = types.get(c, "string" if not fields else None)
        reason = "type" if declared == "email" else "name" if "email" in c.lower() else \
            "pattern" if declared in TEXT_TYPES else None
        if reason is not None:
            out.append((c, reason, F.count_if(not_blank(f"`{c}`")), F.count_if(is_email(f"`{c}`"))))
    return out


def email_columns(df: DataFrame, fields: Sequence[FieldMeta] = (), skip: Collection[str] = ()) -> DataFrame:
    """(column, reason, non_blank, emails, selected) for each text column, in one pass.

    A column is selected by its type, by a name that contains "email", or when more than half of
    its non-blank values are addresses.
    """
    found = email_candidates(df, fields, skip)
    if not found:
        return small_frame(df.sparkSession, [], "column string, reason string, non_blank bigint, "
                                                   "emails bigint, selected boolean")
    aggs = [a.alias(f"{k}{i}") for i, (_, _, n, e) in enumerate(found) for k, a in (("n", n), ("e", e))]
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(r).alias("reason"), F.col(f"n{i}").alias("non_blank"),
                               F.col(f"e{i}").alias("emails"), (F.lit(r != "pattern") | (F.col(f"e{i}") * 2 > F.col(f"n{i}"))).alias("selected"))
                      for i, (c, r, _, _) in enumerate(found)])
    return df.agg(*aggs).select(F.inline(lines))


def masked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: mask_email(c) for c in columns}) if columns else df


def mask_emails(df: DataFrame, fields: Sequence[FieldMeta] = (), skip: Collection[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with addresses masked, (column, masked) counts).

    The profile runs now and brings one line per text column to the driver; everything else is lazy.
    """
    chosen = [r["column"] for r in email_columns(df, fields, skip).where("selected").collect()]
    return masked(df, chosen), count_masked(df, chosen)


def count_masked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if not columns:
        return small_frame(df.sparkSession, [], "column string, masked bigint")
    counts = df.agg(*[F.count_if(needs_mask(c)).alias(f"m{i}") for i, c in enumerate(columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("masked")) for i, c in enumerate(columns)])))


def defer_values(df: DataFrame, table: str, key: str, col: str, paired: str | None = None,
                 when: str = "Custom", temp: str = "All") -> tuple[DataFrame, DataFrame]:
    """Hold back a value that cannot be loaded yet.

    Rows with value ``when`` and a key get ``temp`` and a blank paired column. The second frame
    (table, key, column, value) remembers both originals.
    """
    hit = F.coalesce(F.col(col) == when, F.lit(False)) & (F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    held = [c for c in (col, paired) if c and c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in held])
    deferred = (df.where(hit).select(F.col(key).cast("string").alias("key"), F.explode(pairs).alias("p"))
                .select(F.lit(table).alias("table"), "key", "p.column", "p.value"))
    changes = {col: F.when(hit, temp).otherwise(F.col(col))}
    if paired and paired in df.columns:
        changes[paired] = F.when(~hit, F.col(paired))
    return df.withColumns(changes), deferred


def restore_deferred(target: DataFrame, deferred: DataFrame, key: str, cols: Sequence[str],
                     key_xwalk: DataFrame | None = None) -> DataFrame:
    """Put held back values in place, with keys translated where the target renumbered them."""
    held = deferred
    if key_xwalk is not None:
        moved = key_xwalk.select(F.col("source_key").alias("_from"), F.col("target_key").alias("_to"))
        held = (deferred.join(moved, F.col("key") == F.col("_from"), "left")
                .withColumn("key", F.coalesce("_to", "key")))
    wide = held.groupBy(F.col("key").alias("_key")).agg(*[x for i, c in enumerate(cols) for x in (
        F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_v{i}"),
        F.max(F.col("column") == c).alias(f"_h{i}"))])
    joined = target.join(wide, F.col(key).cast("string") == F.col("_key"), "left")
    at = {c: i for i, c in enumerate(cols)}
    return joined.select(*[
        F.when(F.col(f"_h{at[c]}"), F.col(f"_v{at[c]}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in at else F.col(c) for c in target.columns])


def columns_to_strip(columns: Sequence[str], fields: Sequence[FieldMeta], spec: TableSpec, resolved: Collection[str],
                     used: Collection[str]) -> list[str]:
    """What the target would not accept.

    Ownership columns, columns the target lacks or does not let anyone write, references
    whose raw ids were not ``resolved``, and the relationship key of such a reference when no row has one (it is not ``used``).
    """
    known = {f.name: f for f in fields}
    key_cols = {r.key_col: r for r in spec.refs}
    strip = []
    for c in columns:
        if c in key_cols or c in (spec.key, spec.id_col, "_source_id") or c in ALWAYS_LOADED:
            continue
        f = known.get(c)
        if c in NEVER_LOADED or f is None:
            strip.append(c)
        elif f.is_reference:
            if c not in resolved:
                strip.append(c)
        elif not f.createable and not f.updateable:
            strip.append(c)
    raw = set(strip)
    return strip + [c for c, r in key_cols.items() if c in columns and r.col in raw and c not in used]


def strip_columns(df: DataFrame, fields: Sequence[FieldMeta], spec: TableSpec,
                  resolved: Collection[str] = ()) -> tuple[DataFrame, list[str]]:
    """Drop what the target would not accept (see :func:`columns_to_strip`); returns the dropped names too.

    Whether relationship keys are used needs one aggregate over all of them, which runs now.
    """
    keys = [r.key_col for r in spec.refs if r.key_col in df.columns]
    used = df.agg(*[F.coalesce(F.max(not_blank(c)), F.lit(False)).alias(c) for c in keys]).first() if keys else {}
    strip = columns_to_strip(df.columns, fields, spec, resolved, [c for c in keys if used[c]])
    return df.drop(*strip), strip


def drop_listed(frames: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Drop a list of columns per table; names that do not occur are ignored."""
    return {t: df.drop(*columns.get(t, ())) for t, df in frames.items()}


def fixups(df: DataFrame, overrides: Mapping[str, Column | str | bool | int | float] | None = None,
           clean_newlines: Sequence[str] = (), truncate: Mapping[str, int] | None = None) -> DataFrame:
    """Constant values, newlines to a space, texts cut to the length of the target column."""
    changes: dict[str, Column] = {}
    for c in clean_newlines:
        changes[c] = F.regexp_replace(c, r"[\r\n]+", " ")
    for c, n in (truncate or {}).items():
        changes[c] = F.substring(changes.get(c, F.col(c)), 1, n)
    for c, v in (overrides or {}).items():
        changes[c] = v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(changes) if changes else df


def check_rows(df: DataFrame, fields: Sequence[FieldMeta], spec: TableSpec,
               existing_keys: DataFrame | None = None) -> DataFrame:
    """Add ``errors``: why the target would refuse the row; empty when it would not.

    Repeated keys are counted before they are joined back. ``existing_keys`` are keys that an
    insert must not use again.
    """
    tests: list[tuple[Column, Column]] = []
    for f in fields:
        if f.name not in df.columns:
            if not f.nullable and not f.defaulted and f.createable and f.name != spec.id_col:
                tests.append((F.lit(True), F.lit(f"REQUIRED_FIELD_MISSING:{f.name}")))
            continue
        kind = df.schema[f.name].dataType
        if f.length and isinstance(kind, T.StringType):
            tests.append((F.length(f.name) > f.length, F.lit(f"STRING_TOO_LONG:{f.name}")))
        if not f.nullable and not f.defaulted and f.name != spec.id_col:
            missing = is_blank(f.name) if isinstance(kind, T.StringType) else F.col(f.name).isNull()
            tests.append((missing, F.lit(f"REQUIRED_FIELD_MISSING:{f.name}")))
    for r in spec.refs:
        if r.col in df.columns and r.key_col in df.columns:
            tests.append((F.col(r.col).isNotNull() & is_blank(r.key_col), F.lit(f"UNRESOLVED_REFERENCE:{r.col}")))
    columns, out = df.columns, df
    if spec.key and spec.key in columns:
        out = out.withColumn("_k", F.when(not_blank(spec.key), trimmed(spec.key)))
        repeated = (out.where(F.col("_k").isNotNull()).groupBy(F.col("_k").alias("_dup"))
                    .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_dup"))
        out = is_member(out, F.col("_k"), repeated, "_twice")
        tests.append((F.col("_twice"), F.lit(f"DUPLICATE_VALUE:{spec.key}")))
        if existing_keys is not None:
            taken = existing_keys.select(trimmed(existing_keys.columns[0]).alias("_taken")).distinct()
            out = is_member(out, F.col("_k"), taken, "_exists")
            tests.append((F.col("_exists"), F.lit(f"KEY_EXISTS:{spec.key}")))
    errors = F.array_compact(F.array(*[F.when(t, m) for t, m in tests])) if tests \
        else F.array().cast("array<string>")
    return out.select(*columns, errors.alias("errors"))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their errors)."""
    bad = F.size("errors") > 0
    return checked.where(~bad).drop("errors"), checked.where(bad)
