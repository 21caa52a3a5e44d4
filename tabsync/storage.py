"""Cutting lineage and numbering rows, safe against the loss of executors.

Intermediate frames are written as Parquet under the shared folder named by
``spark.checkpoint.dir`` and read back: the copy outlives its executors, keeps column pruning
and gives the optimizer a measured size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Codec of what is written to be read again; about half of what Spark's own choice takes for ids and texts.
COMPRESSION = "zstd"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables; on a cluster it must be configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tabsync-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tabsync/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "frame", partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Write ``df`` once, at ``path`` or a new place of the shared folder, and return a frame over the written copy."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, label: str = "frame", drop: Sequence[str] = (), path: str | None = None,
                        **counters: Column) -> tuple[DataFrame, dict[str, int]]:
    """Like :func:`materialise`, with counters taken while the rows pass by; columns of ``drop`` serve the counters only."""
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    metrics = {"rows": F.count(F.lit(1)), **counters}
    out = materialise(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).drop(*drop), label, path=path)
    return out, {n: int(v or 0) for n, v in seen.get.items()}


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Frame over a few facts known to the driver, with a known size (so that joins can tell)."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    table = pa.Table.from_arrays([pa.array([r[i] for r in rows], to_arrow_type(f.dataType))
                                  for i, f in enumerate(kind.fields)], names=kind.names)
    return spark.createDataFrame(table, schema=kind)


def side_by_side(spark: SparkSession, work: Iterable[Callable[[], object]], threads: int = 4) -> list:
    """Run independent pieces of work whose Spark jobs may share the cluster; results in order.

    The first failure is raised after the others have ended.
    """
    jobs = [inheritable_thread_target(spark)(w) for w in work]
    if len(jobs) < 2 or threads < 2:
        return [j() for j in jobs]
    with ThreadPoolExecutor(threads) as pool:
        futures = [pool.submit(j) for j in jobs]
    return [f.result() for f in futures]


def number_rows(df: DataFrame, order_cols: Sequence[str], name: str = "row_no") -> DataFrame:
    """Add a gapless number from 0 in the order of ``order_cols``, which should be a total order.

    Rows are range-partitioned and sorted by all order columns, so a value that is frequent in the
    leading column is still spread. A row's number is its place in its partition plus the sizes of
    the partitions before it. The sorted rows are written before they are read twice, because a
    repeated range partitioning need not cut at the same rows.
    """
    keys, columns = list(order_cols), [F.col(c) for c in df.columns]
    placed = materialise(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id())
        # The generated number holds the partition in its upper 31 bits, the place in the lower 33.
        .select(*columns, F.shiftright("_m", 33).cast("int").alias("_part"),
                F.col("_m").bitwiseAND((1 << 33) - 1).alias("_place")), "numbered")
    # One row per partition of the sort: the only frame here that meets in a single task.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(offsets), "_part")
            .select(*columns, (F.col("_place") + F.col("_before")).cast("bigint").alias(name)))

