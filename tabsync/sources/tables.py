"""Scans driven by a table spec, and the row filters a spec can ask for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsync.spec import Env, FieldMeta, TableSpec
from tabsync.storage import number_rows, small_frame

# Columns that are never read, column types that are never read, transport members.
AUDIT_COLUMNS = frozenset({"IsDeleted", "SystemModstamp", "CreatedDate", "CreatedById",
                           "LastModifiedDate", "LastModifiedById"})
COMPOUND_TYPES = frozenset({"formula", "address"})
TRANSPORT_COLUMNS = frozenset({"attributes"})

#: Longest list of literal values that stays an IN predicate, which Parquet can skip row groups by; longer ones
#: become a semi join with the same answer, as values take the type of the column first.
MAX_LITERALS = 10_000


def read_env(spark: SparkSession, path: str, tables: Sequence[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Environment over one file or folder per table."""
    suffix = ".parquet" if fmt == "parquet" else ""
    return {t: spark.read.format(fmt).load(f"{path.rstrip('/')}/{t}{suffix}") for t in tables}


def select_columns(spec: TableSpec, fields: Sequence[FieldMeta],
                   default_exclude: Sequence[str] = ()) -> list[str]:
    """Columns to read, id first.

    An explicit ``include`` list wins. Otherwise audit, calculated (unless a reference), compound
    and automatically numbered columns are left out. The id and the key always stay.
    """
    if spec.include:
        wanted = [spec.id_col, *([spec.key] if spec.key and spec.key not in spec.include else []),
                  *spec.include]
        return list(dict.fromkeys(wanted))
    dropped = set(default_exclude) | set(spec.exclude) | AUDIT_COLUMNS | TRANSPORT_COLUMNS

    def keep(f: FieldMeta) -> bool:
        if f.name == spec.key:
            return True
        computed = f.calculated and not f.is_reference
        return not (f.name in dropped or computed or f.auto_number or f.type in COMPOUND_TYPES)

    return [spec.id_col, *[f.name for f in fields if f.name != spec.id_col and keep(f)]]


def scan(env: Env, spec: TableSpec, fields: Sequence[FieldMeta] = (),
         default_exclude: Sequence[str] = ()) -> DataFrame:
    """Filtered projection of a table; both parts reach the file scan."""
    df = env[spec.name]
    described = list(fields) or [FieldMeta(spec.name, c) for c in df.columns]
    if spec.filter:
        df = df.where(spec.filter)
    return df.select(*[c for c in select_columns(spec, described, default_exclude) if c in df.columns])


def merge_column_groups(groups: Sequence[DataFrame], id_col: str) -> DataFrame:
    """Put vertically split parts of a table together by id; a later part wins a shared column."""

    def merge(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [c for c in right.columns if c in left.columns and c != id_col]
        tagged = right.select(id_col, *[F.col(c).alias(f"_new_{c}") if c in shared else F.col(c)
                                        for c in right.columns if c != id_col], F.lit(True).alias("_hit"))
        joined = left.join(tagged, id_col, "full")
        return joined.select(
            id_col,
            *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in shared
              else F.col(c) for c in left.columns if c != id_col],
            *[c for c in right.columns if c not in left.columns])

    return reduce(merge, groups)


def assign_batches(df: DataFrame, order_cols: Sequence[str], size: int) -> DataFrame:
    """Number of the batch of ``size`` rows that a row falls into, in the given total order."""
    return (number_rows(df, order_cols, "_row")
            .withColumn("batch_no", F.floor(F.col("_row") / F.lit(size)).cast("bigint")).drop("_row"))


def in_list(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``col`` is among ``values`` (a short list, or the first column of a frame)."""
    if not isinstance(values, DataFrame):
        kind = df.schema[col].dataType.simpleString()
        texts = [v if v is None or isinstance(v, (str, bytes)) else str(v) for v in values]
        if len(texts) <= MAX_LITERALS:
            return df.where(F.col(col).isin([F.lit(v).try_cast(kind) for v in texts]))
        given = "binary" if any(isinstance(v, bytes) for v in texts) else "string"
        values = small_frame(df.sparkSession, [(v,) for v in texts], f"v {given}").select(F.col("v").try_cast(kind).alias("v"))
    wanted = values.select(F.col(values.columns[0]).alias("_wanted"))
    return df.join(wanted, F.col(col) == F.col("_wanted"), "left_semi")


def path_filter(env: Env, specs: Mapping[str, TableSpec], table: str, path: Sequence[str], col: str,
                values: Sequence | DataFrame) -> DataFrame:
    """Rows of ``table`` whose ancestor along the foreign key columns ``path`` has ``col`` in ``values``.

    The far end is filtered first and the ids travel back through semi joins, so the rows of
    ``table`` move once.
    """
    hops = [table]
    for fk in path:
        ref = next(r for r in specs[hops[-1]].refs if r.col == fk)
        hops.append(ref.to[0])
    ids = in_list(env[hops[-1]], col, values).select(F.col(specs[hops[-1]].id_col).alias("_id"))
    for owner, fk in zip(reversed(hops[1:-1]), reversed(path[1:])):
        ids = (env[owner].join(ids, F.col(fk) == F.col("_id"), "left_semi")
               .select(F.col(specs[owner].id_col).alias("_id")))
    return env[table].join(ids, F.col(path[0]) == F.col("_id"), "left_semi")
