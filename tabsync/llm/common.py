"""Helpers that the operators of this folder share: mapping over whole texts in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 2 << 20
#: Bytes of rows that go to or come from Python at once. Such a batch is held by the JVM and by Python at the same time.
BATCH_BYTES = 4 << 20
#: Lower case of A-Z only; other bytes stay.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def small_batches(spark: SparkSession) -> None:
    """Rows reach Python in batches of at most ``BATCH_BYTES`` in this session from now on; a setting of its own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, BATCH_BYTES)


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about ``limit`` bytes of text; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def append(df: DataFrame, text_col: str, schema: str, make: Callable[[], Callable[[list], Sequence]]) -> DataFrame:
    """``df`` with the columns of ``schema``, computed from whole texts (null: empty) on the executors.

    ``make`` is called once per task and gives a function from a list of texts to one list or array
    per new column. A column of ``df`` that has the name of a new one gives way to it.
    """
    small_batches(df.sparkSession)
    added = T.StructType.fromDDL(schema)
    kept = [f for f in df.schema.fields if f.name == text_col or f.name not in added.names]
    out = T.StructType([f for f in kept if f.name not in added.names] + added.fields)
    kinds = [to_arrow_type(f.dataType) for f in added.fields]
    at, stay = [f.name for f in kept].index(text_col), [i for i, f in enumerate(kept) if f.name not in added.names]

    def run(batches):
        fn = make()
        for batch in batches:
            for part in slices(batch, at):
                texts = [t or "" for t in part.column(at).to_pylist()]
                new = [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, k)
                       for v, k in zip(fn(texts), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in stay] + new, names=out.names)

    return df.select([F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, out)


def crc_of_id(column: Column | str) -> Column:
    """crc32 of an id written as decimal text."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words between white space of ASCII."""
    return text.encode().translate(LOWER).split()
