"""Looking values up in pairs of key and result, for any size of either side and any frequency of a value.

A lookup whose pairs Spark can broadcast, by their files and by what they take in memory, is a plain left join. Beyond that both sides move by the key, so a value that fills much of
the table would be one task. Such values are found by a sketch of the column (frequent items, one pass over the values of all
lookups); their pairs, at most ``HOT`` of them, are broadcast. Rows with such a value, and rows without one, stay where they are while
the others move by the value itself. Where reading the rows twice would repeat a shuffle (the second large lookup of a row, or rows
that come from a join), they take part in the big join under keys of their own that find nothing and are dealt out by a hash of the row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.storage import materialise_counted

#: Most values of a lookup that are treated apart, and the counters that the sketch keeps to find them. A value that has
#: more than about 1.5 / COUNTERS of all rows is always found.
HOT, COUNTERS = 64, 1024
#: Files hold ids in order in a hundredth of what they take in memory, so what Spark estimates by files tells little of a broadcast. Pairs
#: of an estimate over 1 / SURE of the threshold are written and counted; a row takes ROW bytes beside its text, and where all of
#: them take more than EXPANDS thresholds the lookup is a large one, whatever the files take.
SURE, ROW, EXPANDS = 64, 96, 8
#: Names of columns that a lookup adds for its own use.
_KEY, _OWN = "__lookup_key", "__lookup_own"


@dataclass(frozen=True, eq=False)
class Lookup:
    """Find ``value`` among the first column of ``pairs`` and add the second one as ``name``.

    ``pairs`` has one row per key. Keys and results are text; a null value finds nothing.
    """

    value: Column
    pairs: DataFrame
    name: str


def broadcastable(df: DataFrame, memory: int = 0) -> bool:
    """Whether Spark's own estimate of the frame lies below its broadcast threshold, and ``memory``, the bytes it takes there, is not far above."""
    return _estimate(df) <= (most := _threshold(df)) and memory <= EXPANDS * most


def _estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _threshold(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def text_bytes(*columns: str | Column) -> Column:
    """A counter of the bytes that rows with this text take in memory."""
    return F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(ROW)).cast("bigint"))


def _sized(x: Lookup) -> tuple[Lookup, bool]:
    """The lookup, and whether it is a large one. Pairs that may be are written: their side of a join is then read as it is, so that it can be split."""
    if _estimate(x.pairs) * SURE <= _threshold(x.pairs):
        return x, False
    pairs, n = materialise_counted(x.pairs.where(F.col(_KEY).isNotNull()), "pairs", memory=text_bytes(_KEY, x.name))
    return Lookup(x.value, pairs, x.name), not broadcastable(pairs, n["memory"])


def hot_values(df: DataFrame, values: Sequence[Column]) -> list[list[str]]:
    """For each column of text, the values that would fill a task of a join by it; one pass over all columns."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = df.select(*[v.cast("string").alias(f"v{i}") for i, v in enumerate(values)])
    seen = named.agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"approx_top_k(v{i}, {HOT}, {COUNTERS})").alias(f"t{i}") for i in range(len(values))]).first()
    least = max(2, seen["n"] / (4 * max(parts, 8)))
    return [[r["item"] for r in seen[f"t{i}"] or () if r["item"] is not None and r["count"] >= least] for i in range(len(values))]


def look_up(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Add the result of each lookup as a column; no row is lost or doubled, the answer is the same whatever the sizes."""
    columns = df.columns
    lookups = [Lookup(x.value.cast("string"), x.pairs.select(F.col(x.pairs.columns[0]).cast("string").alias(_KEY),
                                                            F.col(x.pairs.columns[1]).cast("string").alias(x.name)), x.name) for x in lookups]
    lookups, sizes = zip(*map(_sized, lookups), strict=True) if lookups else ((), ())
    large = [i for i, too_many in enumerate(sizes) if too_many]
    hot = dict(zip(large, hot_values(df, [lookups[i].value for i in large]), strict=True)) if large else {}
    # Rows are read twice by the first large lookup alone, which comes before the joins of the others.
    first = large[0] if large and only_read(df) else None
    for i in sorted(range(len(lookups)), key=lambda i: i != first):
        x = lookups[i]
        df = _moved(df, x, hot[i]) if i == first else _spread(df, x, hot[i]) if i in hot else df.join(x.pairs, x.value == F.col(_KEY), "left").drop(_KEY)
    return df.select(*[F.col(f"`{c}`") for c in columns], *[x.name for x in lookups])


def only_read(df: DataFrame) -> bool:
    """Whether the rows come straight from their files, so that reading them twice moves nothing twice."""
    steps = df._jdf.queryExecution().optimizedPlan().toString().rstrip().split("\n")
    return all(re.match(r"[\s:+-]*(Project|Filter|Relation|Union|LocalRelation)\b", s) for s in steps)


def _moved(df: DataFrame, x: Lookup, hot: Sequence[str]) -> DataFrame:
    """A join on a large side to which only rows with a value that is not frequent move, without further columns."""
    apart = x.value.isNull() | x.value.isin(*hot) if hot else x.value.isNull()
    joined = df.where(~apart).join(x.pairs.hint("merge"), x.value == F.col(_KEY), "left").drop(_KEY)
    stay = df.where(apart)
    if not hot:
        return joined.unionByName(stay.withColumn(x.name, F.lit(None).cast("string")))
    few = F.broadcast(x.pairs.where(F.col(_KEY).isin(*hot)))  # at most HOT rows
    return joined.unionByName(stay.join(few, x.value == F.col(_KEY), "left").drop(_KEY))


def _spread(df: DataFrame, x: Lookup, hot: Sequence[str]) -> DataFrame:
    """A join on a large side in which no value fills a task."""
    columns = df.columns
    frequent = x.value.isin(*hot) if hot else F.lit(False)
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)] or [F.lit(0)]
    apart = F.concat(F.lit("-"), F.xxhash64(*hashed).cast("string"))
    own = F.when(x.value.isNull() | frequent, apart).otherwise(F.concat(F.lit("="), x.value))
    rest = x.pairs.select(F.concat(F.lit("="), _KEY).alias(_KEY), F.col(x.name))
    # Worked out where rows are dealt out and where they meet, so that it does not move with them.
    out = df.join(rest.hint("merge"), F.coalesce(own, F.lit("-")) == F.col(_KEY), "left").drop(_KEY)
    if not hot:
        return out
    few = F.broadcast(x.pairs.where(F.col(_KEY).isin(*hot)).select(_KEY, F.col(x.name).alias(_OWN)))  # at most HOT rows
    both = out.join(few, x.value == F.col(_KEY), "left")
    return both.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(F.col(x.name), F.col(_OWN)).alias(x.name))


def is_member(df: DataFrame, value: Column, members: DataFrame, name: str) -> DataFrame:
    """``df`` with whether a value is in the first column of ``members`` (each once)."""
    pairs = members.select(F.col(members.columns[0]).alias("_m"), F.lit("y").alias("_y"))
    return look_up(df, [Lookup(value, pairs, name)]).withColumn(name, F.col(name).isNotNull())
