"""Writing to a target: every step yields a new version of a table, never an overwrite.

A version is the table before and a change set: the rows that the step wrote, whole, with the trace of what happened to them. Only
change sets are written, so a step costs as many bytes as its batch; :class:`Version` reads a table as its base
without the rows that were written since, and those in their last form. ``compact`` writes such a table whole on request.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.functions import has_key, not_blank
from tabsync.operators.clean import (RETRYABLE_PATTERNS, classify_rejects, last_per_key,
                                     route_by_membership, split_by_key, union_results)
from tabsync.operators.lookup import Lookup, look_up
from tabsync.spec import Env, TableSpec
from tabsync.storage import materialise, materialise_counted, number_rows

#: Columns that a write adds to the target's own: what happened to a row, where it came from, and
#: how it looked before.
TRACE = ("_op", "_source_id", "_source_key", "_prior")


def conform(df: DataFrame, schema: T.StructType, invalid: str = "_invalid") -> DataFrame:
    """Give columns the target's types, as text files need.

    Unreadable values become null and are named in ``invalid``, so that the row can be refused; blank text is no value.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    cast = {c: F.col(c).try_cast(kinds[c]) for c in df.columns if c in kinds and kinds[c] != df.schema[c].dataType}
    given = lambda c: not_blank(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c).isNotNull()
    lost = [F.when(given(c) & v.isNull(), F.lit(f"INVALID_VALUE:{c}")) for c, v in cast.items()]
    errors = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    return df.select(*[cast[c].alias(c) if c in cast else F.col(c) for c in df.columns if c != invalid], errors.alias(invalid))


def _trace(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _prior(target: DataFrame):
    return F.struct(*[F.col(c) for c in target.columns])


def untouched(target: DataFrame) -> DataFrame:
    kind = T.StructType(target.schema.fields)
    null = F.lit(None).cast("string")
    return target.select("*", null.alias("_op"), null.alias("_source_id"), null.alias("_source_key"),
                         F.lit(None).cast(kind).alias("_prior"))


def updated_rows(target: DataFrame, batch: DataFrame, on: str) -> DataFrame:
    """Target rows whose ``on`` matches, with the batch's values and the trace columns: the change set of an update.

    Columns that the batch lacks keep their value. Of batch rows that share a value of ``on`` the one of
    largest source id counts, so the target never gains rows. A small batch is broadcast by Spark and the target does not move;
    otherwise the reduction and the join share a shuffle.
    """
    batch = last_per_key(batch.where(F.col(on).isNotNull()), on, ("_source_id",) if "_source_id" in batch.columns else (on,))
    given = [c for c in batch.columns if c in target.columns and c != on]
    incoming = batch.select(F.col(on).alias("_on"), *[F.col(c).alias(f"_b_{c}") for c in given],
                            _trace(batch, "_source_id").cast("string").alias("_source_id"),
                            _trace(batch, "_source_key").cast("string").alias("_source_key"))
    joined = target.join(incoming, F.col(on) == F.col("_on"))
    return joined.select(
        *[F.col(f"_b_{c}").cast(target.schema[c].dataType).alias(c) if c in given else F.col(c) for c in target.columns],
        F.lit("update").alias("_op"), "_source_id", "_source_key", _prior(target).alias("_prior"))


def traced(target: DataFrame, changes: DataFrame, id_col: str) -> DataFrame:
    """The target after a change set, with the trace columns: null for rows that the set does not have."""
    return untouched(_others(target, changes, id_col)).unionByName(changes)


def _others(target: DataFrame, changes: DataFrame, id_col: str) -> DataFrame:
    """Rows of the target that a change set leaves as they are."""
    written = changes.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_written"))
    return target.join(written, F.col(id_col) == F.col("_written"), "left_anti")


@dataclass(frozen=True)
class Version:
    """A table as a base and the change sets written since, oldest first. ``id_col`` tells rows apart; rows without an id are only ever added."""

    base: DataFrame
    id_col: str
    sets: tuple[DataFrame, ...] = ()

    def add(self, changes: DataFrame) -> Version:
        """After one more change set, which should be a written frame."""
        return replace(self, sets=(*self.sets, changes))

    def read(self) -> DataFrame:
        """The table as it stands: one anti join however many sets there are. Rows whose last change is a deletion are gone."""
        if not self.sets:
            return self.base
        columns = self.base.columns
        changed = reduce(DataFrame.unionByName, [s.select(*columns, "_op", F.lit(i).alias("_set")) for i, s in enumerate(self.sets)])
        last = changed
        if len(self.sets) > 1:
            named, unnamed = changed.where(F.col(self.id_col).isNotNull()), changed.where(F.col(self.id_col).isNull())
            last = last_per_key(named, self.id_col, ("_set",)).unionByName(unnamed)
        return _others(self.base, changed, self.id_col).unionByName(last.where("_op != 'delete'").select(*columns))

    def compact(self, label: str = "table") -> Version:
        """The same table, written whole."""
        return replace(self, base=materialise(self.read(), label), sets=())


def update(target: DataFrame, batch: DataFrame, on: str) -> DataFrame:
    """Target rows with the batch's values where ``on`` matches, plus the trace columns.

    Like :func:`updated_rows`, with the other rows; a left join from the target, which may have rows without an id.
    """
    batch = last_per_key(batch.where(F.col(on).isNotNull()), on, ("_source_id",) if "_source_id" in batch.columns else (on,))
    given = [c for c in batch.columns if c in target.columns and c != on]
    incoming = batch.select(F.col(on).alias("_on"), F.lit(True).alias("_hit"),
                            *[F.col(c).alias(f"_b_{c}") for c in given],
                            _trace(batch, "_source_id").cast("string").alias("_source_id"),
                            _trace(batch, "_source_key").cast("string").alias("_source_key"))
    hit = F.col("_hit").isNotNull()
    joined = target.join(incoming, F.col(on) == F.col("_on"), "left")
    return joined.select(
        *[F.when(hit, F.col(f"_b_{c}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
          if c in given else F.col(c) for c in target.columns],
        F.when(hit, "update").alias("_op"), "_source_id", "_source_key", F.when(hit, _prior(target)).alias("_prior"))


def fresh_ids(target: DataFrame, batch: DataFrame, id_col: str, order_cols: Sequence[str],
              prefix: str = "new") -> DataFrame:
    """Give the batch ids that the target does not use.

    Whole numbers continue after the highest one; text ids are the prefix and 15 digits. Ids
    follow ``order_cols``, so a repeated run gives the same ones.
    """
    kind = target.schema[id_col].dataType
    numbered = number_rows(batch.drop(id_col), order_cols, "_no")
    if isinstance(kind, T.StringType):
        mine = F.regexp_extract(id_col, rf"\A{prefix}(\d{{15}})\z", 1)
        top = target.agg(F.max(F.when(mine != "", mine.cast("bigint")))).first()[0]
        value = F.concat(F.lit(prefix), F.lpad((F.col("_no") + (0 if top is None else top + 1)).cast("string"), 15, "0"))
    else:
        top = target.agg(F.max(id_col)).first()[0]
        value = (F.col("_no") + (1 if top is None else top + 1)).cast(kind)
    return numbered.withColumn(id_col, value).drop("_no")


def insert(target: DataFrame, batch: DataFrame, id_col: str, order_cols: Sequence[str],
           auto_key: str | None = None) -> DataFrame:
    """Rows to add, in the target's layout with fresh ids and trace columns."""
    added = fresh_ids(target, batch, id_col, order_cols)
    if auto_key:  # the target numbers this key itself
        added = added.withColumn(auto_key, F.concat(F.lit("A-"), F.col(id_col).cast("string")))
    kind = T.StructType(target.schema.fields)
    return added.select(
        *[(F.col(c) if c in added.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
          for c in target.columns],
        F.lit("insert").alias("_op"), _trace(added, "_source_id").cast("string").alias("_source_id"),
        _trace(added, "_source_key").cast("string").alias("_source_key"), F.lit(None).cast(kind).alias("_prior"))


def upserted_rows(target: DataFrame, batch: DataFrame, key: str, id_col: str,
                  order_cols: Sequence[str] | None = None) -> DataFrame:
    """Change set of an update by key and an insert of the rest, with the trace columns.

    The batch has at most one row per key; rows with a blank key are all inserted. Which rows are
    new is found from the key columns alone.
    """
    batch = batch.withColumn("_source_key", F.col(key).cast("string")) if "_source_key" not in batch.columns else batch
    named, unnamed = split_by_key(batch, key)
    known = target.select(F.col(key).alias("_known")).where(has_key("_known"))
    hits = known.join(named.select(F.col(key).alias("_k")), F.col("_known") == F.col("_k"), "left_semi").distinct()
    new = named.join(hits, F.col(key) == F.col("_known"), "left_anti")
    added = new.unionByName(unnamed, allowMissingColumns=True)
    return updated_rows(target, named.drop(id_col), key).unionByName(insert(target, added, id_col, order_cols or (key,)))


def upsert(target: DataFrame, batch: DataFrame, key: str, id_col: str,
           order_cols: Sequence[str] | None = None) -> DataFrame:
    """Update by key, insert the rest; the target's columns plus the trace columns.

    Only the rows that the batch touches are written; the others are read from the target.
    """
    return traced(target, materialise(upserted_rows(target, batch, key, id_col, order_cols), "changes"), id_col)


def upserted_rows_by_id(target: DataFrame, batch: DataFrame, id_col: str, order_cols: Sequence[str],
                        auto_key: str | None = None) -> DataFrame:
    """Change set: rows that carry a target id are updated, those without inserted."""
    known, new = batch.where(F.col(id_col).isNotNull()), batch.where(F.col(id_col).isNull())
    return updated_rows(target, known, id_col).unionByName(insert(target, new, id_col, order_cols, auto_key))


def upsert_by_id(target: DataFrame, batch: DataFrame, id_col: str, order_cols: Sequence[str],
                 auto_key: str | None = None) -> DataFrame:
    """Update the rows that carry a target id, insert those without."""
    return traced(target, materialise(upserted_rows_by_id(target, batch, id_col, order_cols, auto_key), "changes"), id_col)


def current(written: DataFrame) -> DataFrame:
    """The table as it stands after a write."""
    return written.drop(*TRACE)


def loaded_rows(written: DataFrame, order: int, table: str, id_col: str, key: str | None) -> DataFrame:
    """What a write did: order, table, op, source and target id and key, prior image."""
    return written.where(F.col("_op").isNotNull()).select(
        F.lit(order).alias("order"), F.lit(table).alias("table"), F.col("_op").alias("op"),
        F.col("_source_id").alias("source_id"), F.col(id_col).cast("string").alias("target_id"),
        F.col("_source_key").alias("source_key"),
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("target_key"),
        F.col("_prior").alias("prior"))


def deleted_rows(target: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Change set of a deletion: the rows that go, with their prior image."""
    gone = ids.select(F.col(ids.columns[0]).alias("_gone"))
    null = F.lit(None).cast("string")
    return target.join(gone, F.col(id_col) == F.col("_gone"), "left_semi").select(
        "*", F.lit("delete").alias("_op"), null.alias("_source_id"), null.alias("_source_key"), _prior(target).alias("_prior"))


def delete_ids(target: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, deleted rows); the deleted rows are written, the kept ones read from the target."""
    gone = materialise(deleted_rows(target, ids, id_col), "deleted")
    return Version(target, id_col).add(gone).read(), current(gone)


def deactivate(target: DataFrame, flag: str, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(target with nothing active, ``id, value`` of what was active); a target without the flag is left alone."""
    if flag not in target.columns:
        return target, None
    active = F.coalesce(F.col(flag).cast("boolean"), F.lit(False))
    kind = target.schema[flag].dataType
    return (target.withColumn(flag, F.when(active, F.lit(False).cast(kind)).otherwise(F.col(flag))),
            target.where(active).select(F.col(id_col).alias("id"), F.col(flag).alias("value")))


def reactivate(target: DataFrame, ids: DataFrame | None, flag: str, id_col: str) -> DataFrame:
    """Switch the remembered rows on again, and no others."""
    if ids is None:
        return target
    marks = ids.groupBy(F.col("id").alias("_was")).agg(F.max("value").alias("_value"))
    return (target.join(marks, F.col(id_col) == F.col("_was"), "left")
            .withColumn(flag, F.when(F.col("_was").isNotNull(), F.col("_value")).otherwise(F.col(flag)))
            .drop("_was", "_value"))


def without_given(ids: DataFrame, loaded: DataFrame) -> DataFrame:
    """Remembered rows that a load did not give a flag of its own; ``loaded`` is what it wrote."""
    own = loaded.where(F.col("op") == "update").select(F.col("target_id").alias("_set"))
    return ids.join(own, F.col("id").cast("string") == F.col("_set"), "left_anti")


def flag_before(loaded: DataFrame, ids: DataFrame, flag: str) -> DataFrame:
    """Log rows whose prior images show the flag as it was before :func:`deactivate`."""
    marks = ids.groupBy(F.col("id").cast("string").alias("_was")).agg(F.max("value").alias("_value"))
    prior = F.when(F.col("_was").isNotNull() & F.col("prior").isNotNull(), F.col("prior").withField(flag, F.col("_value")))
    return (loaded.join(marks, F.col("target_id") == F.col("_was"), "left")
            .withColumn("prior", F.coalesce(prior, F.col("prior"))).drop("_was", "_value"))


def bind_parents(df: DataFrame, spec: TableSpec, target: Env, specs: Mapping[str, TableSpec]) -> DataFrame:
    """Fill foreign keys with the target ids of the parents named by relationship keys.

    ``_unbound`` lists relationship keys that no parent has. A relationship with several parent
    tables takes the first that knows the key.
    """
    refs = [r for r in spec.refs if r.key_col in df.columns]
    lookups, hits = [], {r.col: [] for r in refs}
    for ref in refs:
        for name in ref.to:
            parent = specs.get(name)
            if parent is None or not parent.key or name not in target:
                continue
            held = target[name].where(has_key(parent.key, target[name])).select(
                F.col(parent.key).cast("string").alias("_k"), F.col(parent.id_col).alias("_p"))
            hits[ref.col].append(f"_p{len(lookups)}")
            lookups.append(Lookup(F.col(ref.key_col), last_per_key(held, "_k", ("_p",)), f"_p{len(lookups)}"))
    found = look_up(df, lookups)
    columns, misses = {}, []
    for ref in refs:
        parent_id = F.coalesce(*hits[ref.col]) if hits[ref.col] else F.lit(None).cast("string")
        kind = target[spec.name].schema[ref.col].dataType if ref.col in target[spec.name].columns else T.StringType()
        raw = F.col(ref.col).cast(kind) if ref.col in df.columns else F.lit(None).cast(kind)
        misses.append(F.when(not_blank(ref.key_col) & parent_id.isNull(), F.lit(f"UNRESOLVED_REFERENCE:{ref.col}")))
        columns[ref.col] = F.coalesce(parent_id.cast(kind), raw)
    unbound = F.array_compact(F.array(*misses)) if misses else F.array().cast("array<string>")
    return found.select(*[F.col(c) for c in df.columns if c not in columns],
                        *[v.alias(c) for c, v in columns.items()], unbound.alias("_unbound"))


def retry_rejects(rejects: DataFrame, apply_fn: Callable[[DataFrame, int], tuple[DataFrame, DataFrame]],
                  patterns: Sequence[str] = RETRYABLE_PATTERNS, attempts: int = 2,
                  bookkeeping: Sequence[str] = ("error", "retryable")) -> tuple[DataFrame | None, DataFrame, dict[str, int]]:
    """Submit rejected rows again while their error is transient.

    ``apply_fn(rows, attempt)`` returns (accepted, rejected with an ``error`` column). Result:
    accepted rows or None, every row that is still rejected, and the tally. Each round works on
    the rows the round before left over, which are written so that no round repeats another.
    """
    judged, seen = materialise_counted(classify_rejects(rejects, "error", patterns), "rejects",
                                       retryable=F.count_if("retryable"))
    tally = {"retried": seen["retryable"], "recovered": 0, "failed": seen["rows"]}
    open_rows = judged.where("retryable")
    final, accepted, waiting = [judged.where(~F.col("retryable"))], [], seen["retryable"]
    for attempt in range(1, attempts + 1):
        if not waiting:
            break
        again = open_rows.drop(*bookkeeping, *[c for c in open_rows.columns if c.startswith("sf__")])
        ok, bad = apply_fn(again, attempt)
        ok, good = materialise_counted(ok, "recovered")
        bad, left = materialise_counted(classify_rejects(bad, "error", patterns), "rejects",
                                        retryable=F.count_if("retryable"))
        tally["recovered"] += good["rows"]
        if good["rows"]:
            accepted.append(ok)
        final.append(bad.where(~F.col("retryable")))
        open_rows, waiting = bad.where("retryable"), left["retryable"]
    final.append(open_rows)
    tally["failed"] -= tally["recovered"]
    return (union_results(accepted) if accepted else None), union_results(final).drop("retryable"), tally


def in_two_batches(target: DataFrame, batch: DataFrame, id_col: str, fk: str, first_parents: DataFrame,
                   xwalk: DataFrame | None, changes_of: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Load the rows of certain parents before the others; ``changes_of(target, rows)`` gives the change set of a write.

    Returns the change set of both writes; a row that both wrote keeps the trace of the first.
    """
    first, rest = route_by_membership(batch, fk, first_parents, xwalk)
    once = materialise(changes_of(target, first), "half")
    twice = materialise(changes_of(Version(target, id_col).add(once).read(), rest), "half")
    marks = once.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), *[F.col(c).alias("_1" + c) for c in TRACE])
    joined = twice.join(marks, F.col(id_col) == F.col("_id"), "left")
    again = joined.select(*target.columns, *[F.when(F.col("_id").isNull(), F.col(c)).otherwise(F.col("_1" + c)).alias(c) for c in TRACE])
    return _others(once, twice, id_col).unionByName(again)
