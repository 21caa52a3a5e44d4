"""Shards in Hilbert order: several metadata columns quantised, rows sorted along the curve, cut into runs.

Neighbours on the curve are near in every dimension, so each shard covers a small box and its
minima and maxima let a reader skip it, whatever column it filters by.

Every dimension is cut into cells at approximate quantiles. Text counts by its first bytes behind the
beginning that all values share; null is a cell of its own, before all others. Rows of equal index are
ordered by id, then by content hash, so a cell with a third of all rows is cut like any other run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsync.storage import materialise, number_rows

BITS = 6


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (points, dimensions), by rotating and reflecting bit planes."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> bit) & 1
    return out


def _numeric(df: DataFrame, dims: Mapping[str, Column]) -> tuple[DataFrame, list[str]]:
    """``df`` with each dimension as a double ``__d{i}``."""
    df = df.withColumns({f"__v{i}": c for i, c in enumerate(dims.values())})
    kinds = dict(df.dtypes)
    texts = [f"__v{i}" for i in range(len(dims)) if kinds[f"__v{i}"] == "string"]
    ends = df.agg(*[f(c).alias(f"{f.__name__}{c}") for c in texts for f in (F.min, F.max)]).first() if texts else {}
    out = {}
    for i in range(len(dims)):
        c = f"__v{i}"
        if c in texts:
            low, high = ends[f"min{c}"] or "", ends[f"max{c}"] or ""
            shared = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
            tail = F.substring(F.encode(F.substring(c, shared + 1, 6), "UTF-8"), 1, 6)
            out[f"__d{i}"] = F.conv(F.rpad(F.hex(tail), 12, "0"), 16, 10).cast("double")
        else:
            out[f"__d{i}"] = F.col(c).cast("double")
    return df.withColumns(out).drop(*[f"__v{i}" for i in range(len(dims))]), list(out)


def hilbert_index(df: DataFrame, dims: Mapping[str, Column], bits: int = BITS, out: str = "hilbert") -> DataFrame:
    """``df`` with the curve index of its row. ``dims``: name -> expression (text, number, date or boolean)."""
    df, cols = _numeric(df, dims)
    levels = (1 << bits) - 1
    shares = [k / levels for k in range(1, levels)]
    cuts = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in cols]).first()
    bounds = [np.unique(np.array(cuts[c] or [], float)) for c in cols]

    @F.pandas_udf("long")
    def index(values: pd.DataFrame) -> pd.Series:
        cells = np.zeros((len(values), len(bounds)), np.int64)
        for i, b in enumerate(bounds):
            v = values.iloc[:, i].to_numpy(float)
            cells[:, i] = np.where(np.isnan(v), 0, 1 + np.searchsorted(b, v, "left"))
        return pd.Series(curve_index(cells, bits))
    return df.withColumn(out, index(F.struct(*cols))).drop(*cols)


def shard(df: DataFrame, dims: Mapping[str, Column], shards: int, tie: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` with hilbert, shard and slot: runs of the curve whose row counts differ by one at most.

    ``slot`` is the place in the shard, gapless from 0. Every row gets a place, repeated rows too; columns of ``df``
    with these names give way. ``tie``: columns that order rows of equal index.
    """
    df = df.drop("hilbert", "shard", "slot", "__n")
    indexed = materialise(hilbert_index(df, dims, bits), "hilbert")
    rows = indexed.count()
    numbered = number_rows(indexed, ["hilbert", *tie], "__n")
    shard_no = F.expr(f"(__n * {shards}) div {max(1, rows)}")
    first = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return numbered.withColumn("shard", shard_no.cast("int")).withColumn("slot", F.col("__n") - first).drop("__n")


def shard_ranges(sharded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, minima and maxima of each shard: what a reader prunes by."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in the order of the curve, so that row groups prune as well as files do."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
