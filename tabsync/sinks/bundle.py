"""A bundle: one folder per table, in load order, and a manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.functions import csv_boolean
from tabsync.sources.csv import read_csv
from tabsync.spec import TableSpec
from tabsync.storage import COMPRESSION, small_frame

MANIFEST_SCHEMA = ("mode string, tier int, order int, path string, table string, key_field string, "
                   "rows bigint, operation string, pass2 boolean, notes string")


def table_path(tier: int, order: int, table: str, suffix: str = "") -> str:
    return f"tier-{tier}/{order:02d}-{table}{suffix}"


def as_text(df: DataFrame, headers: Mapping[str, str] | None = None) -> DataFrame:
    """All columns as text, booleans as TRUE and FALSE, relationship keys under dotted headers."""
    headers = headers or {}
    return df.select(*[
        (csv_boolean(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.BooleanType)
         else F.to_json(f"`{f.name}`") if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
         else F.col(f"`{f.name}`").cast("string")).alias(headers.get(f.name, f.name)) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, headers: Mapping[str, str] | None = None) -> None:
    """Quoted CSV files with a header each, in a folder."""
    (as_text(df, headers).write.option("header", True).option("quoteAll", True).option("escape", '"')
     .option("nullValue", "").option("emptyValue", "").csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                headers: Mapping[str, str] | None = None) -> int:
    """Write and return the number of rows, counted in passing."""
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("n"))
    if fmt == "csv":
        write_csv(watched, path, headers)
    else:
        (watched.write.option("compression", COMPRESSION) if fmt == "parquet" else watched.write).format(fmt).save(path)
    return seen.get["n"]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               headers: Mapping[str, str] | None = None) -> DataFrame:
    df = read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    back = {dotted: plain for plain, dotted in (headers or {}).items()}
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns])


def manifest_entry(mode: str, tier: int, order: int, path: str, spec: TableSpec, pass2: bool = False,
                   notes: str | None = None) -> tuple:
    """Manifest line without its row count."""
    if notes is None and spec.active_col and not pass2:
        notes = f"deactivate {spec.active_col}"
    return (mode, tier, order, path, spec.name, spec.key, "upsert" if spec.key else "insert", pass2, notes)


def build_manifest(spark: SparkSession, exports: Sequence[tuple[tuple, DataFrame | int]]) -> DataFrame:
    """Manifest from (line, rows), where rows is a number already known or the frame to count."""
    parts = []
    names = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]
    kinds = dict(f.split() for f in MANIFEST_SCHEMA.split(", "))
    for line, rows in exports:
        values = dict(zip([n for n in names if n != "rows"], line))
        if isinstance(rows, DataFrame):
            counted = rows.agg(F.count(F.lit(1)).alias("rows"))
        else:
            counted = small_frame(spark, [(rows,)], "rows bigint")
        parts.append(counted.select(*[F.col("rows") if n == "rows" else F.lit(values[n]).cast(kinds[n]).alias(n)
                                      for n in names]))
    return reduce(DataFrame.union, parts) if parts else small_frame(spark, [], MANIFEST_SCHEMA)


def write_diff(rows: DataFrame, path: str, fmt: str = "json") -> None:
    """New, modified and deleted rows, in a folder per table and status."""
    rows.where(F.col("status") != "identical").write.partitionBy("table", "status").format(fmt).save(path)


def write_report(found, path: str, fmt: str = "json") -> None:
    """A whole comparison (:class:`tabsync.operators.diff.Diff`): the rows that differ by table and status, every changed field, and the summary."""
    write_diff(found.rows, f"{path}/rows", fmt)
    found.changes.write.partitionBy("table").format(fmt).save(f"{path}/changes")
    found.summary.coalesce(1).write.format(fmt).save(f"{path}/summary")  # a line per table


def write_results(ok: DataFrame, bad: DataFrame, table: str, path: str, fmt: str = "parquet") -> None:
    """Accepted and rejected rows of a table, in a folder per table and outcome."""
    both = ok.withColumn("outcome", F.lit("success")).unionByName(
        bad.withColumn("outcome", F.lit("failure")), allowMissingColumns=True)
    both.withColumn("table", F.lit(table)).write.mode("append").partitionBy("table", "outcome").format(fmt).save(path)
