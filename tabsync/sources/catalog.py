"""Table and column inventory, row counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsync.spec import Env, FieldMeta, TableSpec
from tabsync.storage import small_frame

# Technical tables by the ending of their name.
TECHNICAL_SUFFIXES = ("__History", "__Tag", "__Share", "__Feed", "__ChangeEvent")

FIELDS_SCHEMA = ("table string, field string, type string, reference_to array<string>, relationship string, "
                 "is_key boolean, nullable boolean, createable boolean, updateable boolean, "
                 "calculated boolean, auto_number boolean, defaulted boolean, length int")


def usable_table_names(names: Iterable[str], prefixes: Sequence[str] = ()) -> list[str]:
    """Sorted names without technical tables, reduced to the given prefixes."""
    return sorted(n for n in names if not n.endswith(TECHNICAL_SUFFIXES)
                  and (not prefixes or n.startswith(tuple(prefixes))))


def row_counts(env: Env, tables: Sequence[TableSpec | str]) -> DataFrame:
    """(table, records) for each table, with its filter; -1 for a table that cannot be read."""
    counts, failed = [], []
    for entry in tables:
        spec = entry if isinstance(entry, TableSpec) else TableSpec(entry)
        try:
            df = env[spec.name]
            df = df.where(spec.filter) if spec.filter else df
            df.schema  # resolve now: a bad filter or a missing table counts as -1
        except (KeyError, PySparkException):
            failed.append(spec.name)
            continue
        counts.append(df.agg(F.count(F.lit(1)).alias("records"))
                      .select(F.lit(spec.name).alias("table"), "records"))
    if failed:
        spark = next(iter(env.values())).sparkSession if env else SparkSession.getActiveSession()
        counts.append(small_frame(spark, [(t, -1) for t in failed], "table string, records bigint"))
    return reduce(DataFrame.unionByName, counts)


def column_inventory(spark: SparkSession, env: Env, specs: Sequence[TableSpec] = (),
                     known: Iterable[FieldMeta] = ()) -> DataFrame:
    """One row per column: type from the schema, flags from what is known about it."""
    flags = {(f.table, f.name): f for f in known}
    by_table = {s.name: s for s in specs}
    rows = []
    for table, df in env.items():
        spec = by_table.get(table)
        refs = {r.col: r for r in spec.refs} if spec else {}
        for field in df.schema.fields:
            ref = refs.get(field.name)
            meta = flags.get((table, field.name)) or FieldMeta(
                table, field.name, "reference" if ref else field.dataType.simpleString(),
                ref.to if ref else (), ref.relationship if ref else None,
                bool(spec and spec.key == field.name), field.nullable)
            rows.append((table, meta.name, meta.type, list(meta.reference_to), meta.relationship,
                         meta.is_key, meta.nullable, meta.createable, meta.updateable, meta.calculated,
                         meta.auto_number, meta.defaulted, meta.length))
    return small_frame(spark, rows, FIELDS_SCHEMA)


def discover_tables(env: Env, prefixes: Sequence[str] = (), min_records: int = 0,
                    specs: Sequence[TableSpec] = (),
                    known: Iterable[FieldMeta] = ()) -> tuple[DataFrame, DataFrame]:
    """(tables with at least ``min_records`` rows, their columns)."""
    names = usable_table_names(env, prefixes)
    spark = next(iter(env.values())).sparkSession
    tables = row_counts(env, names).where(F.col("records") >= min_records)
    fields = column_inventory(spark, {n: env[n] for n in names}, specs, known)
    return tables, fields.join(tables.select("table"), "table", "left_semi")


def catalog_env(spark: SparkSession, database: str | None = None,
                prefixes: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Environment over the tables of a catalog schema."""
    names = usable_table_names((t.name for t in spark.catalog.listTables(database)), prefixes)
    return {n: spark.table(f"{database}.{n}" if database else n) for n in names}
