"""Load log, totals, and undoing a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tabsync.functions import not_blank, trimmed
from tabsync.operators.clean import union_results
from tabsync.spec import Env, TableSpec

LOG_SCHEMA = ("order int, table string, key_field string, submitted bigint, succeeded bigint, "
              "failed bigint, status string")


def load_status(failed: Column, aborted: Column) -> Column:
    return F.when(aborted, "failed").when(failed > 0, "partial").otherwise("success")


def load_log(outcomes: DataFrame) -> DataFrame:
    """One line per table and step from one row per submitted row.

    ``outcomes`` has (order, table, key_field, accepted, aborted).
    """
    counted = outcomes.groupBy("order", "table", "key_field").agg(
        F.count(F.lit(1)).alias("submitted"), F.count_if("accepted").alias("succeeded"),
        F.count_if(~F.col("accepted")).alias("failed"), F.max("aborted").alias("_aborted"))
    return counted.select("order", "table", "key_field", "submitted", "succeeded", "failed",
                          load_status(F.col("failed"), F.col("_aborted")).alias("status"))


def load_summary(log: DataFrame) -> DataFrame:
    """(table, submitted, succeeded, failed) with a TOTAL line."""
    out = log.rollup("table").agg(F.grouping("table").alias("_t"), *[
        F.sum(c).cast("bigint").alias(c) for c in ("submitted", "succeeded", "failed")])
    return out.select(F.when(F.col("_t") == 1, "TOTAL").otherwise(F.col("table")).alias("table"),
                      "submitted", "succeeded", "failed")


def loaded_ids(accepted: DataFrame, id_col: str, key: str | None = None,
               recovered: DataFrame | None = None) -> DataFrame:
    """(target_id, key) of the accepted rows and those a retry recovered; blanks are left out."""
    rows = union_results([f for f in (accepted, recovered) if f is not None])
    value = lambda c: F.when(not_blank(c), trimmed(c)) if c else F.lit(None).cast("string")
    return (rows.select(value(id_col).alias("target_id"), value(key).alias("key"))
            .where(F.col("target_id").isNotNull() | F.col("key").isNotNull()))


def counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Counters that are filled while the rows are written or read for another purpose."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counters.items()]), seen


def load_plan(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy("tier", "order")


def rollback_plan(log: DataFrame) -> DataFrame:
    """(table, order, records): tables with a successful step, latest load first, each once."""
    return (log.where(F.col("succeeded") > 0).groupBy("table")
            .agg(F.max("order").alias("order"), F.sum("succeeded").cast("bigint").alias("records"))
            .orderBy(F.col("order").desc()))


def ids_for_keys(target: DataFrame, spec: TableSpec, keys: DataFrame) -> DataFrame:
    """Ids of the rows whose key is in the first column of ``keys``."""
    wanted = keys.select(F.col(keys.columns[0]).alias("_key"))
    return (target.join(wanted, F.col(spec.key).cast("string") == F.col("_key"), "left_semi")
            .select(F.col(spec.id_col).cast("string").alias("id")))


def undo_table(target: DataFrame, loaded: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(target without the load, one report line).

    Rows that the load added go away, rows that it changed get their prior image back. When a row
    was loaded more than once, its first step tells how it was before. Log entries without an id
    are found by key.
    """
    first = Window.partitionBy("target_id").orderBy("order")
    by_id = loaded.where(F.col("target_id").isNotNull()).select("target_id", "order", "op", "prior")
    if spec.key:
        keyed = loaded.where(F.col("target_id").isNull() & F.col("target_key").isNotNull())
        held = target.select(F.col(spec.key).cast("string").alias("_k"), F.col(spec.id_col).cast("string").alias("_i"))
        by_id = by_id.unionByName(keyed.join(held, F.col("target_key") == F.col("_k"))
                                  .select(F.col("_i").alias("target_id"), "order", "op", "prior"))
    steps = (by_id.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1)
             .select(F.col("target_id").alias("_id"), F.col("op").alias("_op"), F.col("prior").alias("_prior")))
    joined = target.join(steps, F.col(spec.id_col).cast("string") == F.col("_id"), "left")
    undone = (joined.where(F.col("_op").isNull() | (F.col("_op") != "insert"))
              .select(*[F.when(F.col("_op") == "update", F.col(f"_prior.{c}")).otherwise(F.col(c)).alias(c)
                        for c in target.columns]))
    logged = F.coalesce(F.col("target_id"), F.col("target_key"))
    zero = F.lit(0).cast("bigint")
    effects = joined.agg(F.count_if(F.col("_op") == "insert").alias("deleted"),
                         F.count_if(F.col("_op") == "update").alias("restored"))
    entries = loaded.select(logged.alias("l")).distinct().agg(F.count("l").alias("logged"))
    report = (effects.select(zero.alias("logged"), "deleted", "restored")
              .union(entries.select("logged", zero, zero))
              .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("logged", "deleted", "restored")]))
    found = F.col("deleted") + F.col("restored")
    status = F.when(found == 0, "SKIP").when(found < F.col("logged"), "PARTIAL").otherwise("OK")
    return undone, report.select(F.lit(spec.name).alias("table"), "logged", "deleted", "restored",
                                 status.alias("status"))


def undo(target: Env, loaded: Mapping[str, DataFrame], specs: Mapping[str, TableSpec],
         order: Sequence[str]) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Undo a load table by table in the given order; (environment, report)."""
    env, lines = dict(target), []
    for table in order:
        if table in loaded and table in env:
            env[table], line = undo_table(env[table], loaded[table], specs[table])
            lines.append(line)
    return env, (reduce(DataFrame.union, lines) if lines else None)
