"""Lenient CSV input; files with newlines inside of values are read by many tasks, too."""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.storage import materialise

#: Line ends inside quotes stay as they are; with Spark's own choice CRLF would turn into LF there.
_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "lineSep": "\r\n"}
#: States at a quote: at the start of a record, in a bare value, inside quotes, behind a quote that ends or doubles.
_START, _BARE, _INSIDE, _BEHIND = 0, 1, 2, 3


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """Header row, byte order mark, doubled quotes, quoted newlines, quotes within bare values, short and long rows, LF or CRLF.

    Every value is text; empty ones are null. A folder's first file names the columns, each file has a header. Rows come in no order.
    The lines are written once to the shared folder, see :func:`csv_records`; ``multi_line=False`` is for files known to have no quoted
    newlines, which Spark reads as they are.
    """
    if not multi_line:
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").option("encoding", "UTF-8")
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    records = csv_records(spark, path)
    if schema is None:
        first = records.where("is_header").orderBy("file").select("record").first()  # one row
        schema = T.StructType([T.StructField(n, T.StringType()) for n in _names(first["record"] if first else "")])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not schema.fields:
        return spark.createDataFrame([], schema)
    ddl = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    rows = records.where("NOT is_header").select(F.from_csv("record", F.lit(ddl), _OPTIONS).alias("r"))
    return rows.select(*[F.col(f"r.{_quoted(n)}") for n in schema.names])


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _names(header: str) -> list[str]:
    """Column names of a header; nameless and repeated ones (in any case) get their place."""
    found = next(csv.reader(io.StringIO(header, newline="")), [])
    lower = [n.lower() for n in found]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(found)]


def _ends_inside(line: Column, start: int) -> Column:
    """Whether a line that begins in this state ends inside quotes.

    A quote opens a value at its start only, else it is a character of a bare value. Inside, it ends the value unless another
    follows; what comes between an ending quote and the next comma is bare.
    """
    def step(state: Column, before: Column) -> Column:
        opens = before.endswith(",")
        return (F.when(state == _INSIDE, _BEHIND)
                .when(opens | ((before == "") & state.isin(_START, _BEHIND)), _INSIDE).otherwise(_BARE))
    parts = F.split(line, '"')
    return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), F.lit(start), step) == _INSIDE


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, is_header`` of CSV files, which any number of tasks read together; blank lines between records go.

    Each line is a function of the state at its start (inside quotes or not) to the state at its end: it keeps it, turns it
    round, or fixes it. As these compose, the state before a line is the last fixed one before it, turned as often as
    lines turn it since then. That is worked out over the blocks of a file first (a row for each block). Blocks in which no
    line opens a value that goes on, nearly all of most files, are not shuffled; of the others the lines are followed block by
    block, and only lines that are no whole records are put together.

    The lines are written once, so that all steps see the same blocks. A file that ends inside a quoted value ends with a
    record that holds the rest. Line ends inside of values stay; CRLF or LF end a record.
    """
    quoted = F.col("value").contains('"')
    lines = (spark.read.text(path, lineSep="\n")
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .select("*", F.monotonically_increasing_id().alias("at"))
             # A byte order mark can only stand at the very start.
             .withColumn("value", F.when(F.col("block") == 0, F.regexp_replace("value", "\\A\ufeff", "")).otherwise(F.col("value")))
             .withColumn("opens", quoted & _ends_inside(F.col("value"), _START))
             .withColumn("stays", ~quoted | _ends_inside(F.col("value"), _INSIDE)))
    lines = materialise(lines, "lines")
    fixes, turns = F.col("opens") == F.col("stays"), F.col("opens") & ~F.col("stays")
    full = ~F.col("value").isin("", "\r")
    key = ["file", "block"]

    # A row for each block, written so that Spark knows how few they are and leaves the lines where they are.
    last = materialise(lines.groupBy(*key).agg(F.max(F.when(fixes, F.struct("at", F.col("opens").cast("int").alias("v")))).alias("last"), F.count_if("opens").alias("n_opens"),
                                   F.min(F.when(full, F.col("at"))).alias("first")), "last")
    since = lines.join(last, key).groupBy(*key).agg(
        F.any_value("last.v").alias("fixed"), F.any_value("n_opens").alias("n_opens"), F.any_value("first").alias("first"),
        F.count_if(turns & (F.col("at") > F.coalesce(F.col("last.at"), F.lit(-1)))).alias("turned"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of a file
    blocks = since.withColumn("before", F.coalesce(F.sum("turned").over(earlier), F.lit(0)))
    # A block that fixes the state ends in ``fixed``, turned ``turned`` times; ``before`` of later blocks counts these turns, too.
    blocks = blocks.select(*key, "n_opens", ((F.coalesce(F.last(F.col("fixed") + F.col("before"), True).over(earlier), F.lit(0)) + F.col("before")) % 2).alias("inside"),
                           F.when(F.count("first").over(earlier) == 0, F.col("first")).alias("header_at"))
    blocks = materialise(blocks, "blocks")

    placed = lines.join(blocks, key).withColumn("is_header", F.coalesce(F.col("at") == F.col("header_at"), F.lit(False)))
    calm = (F.col("n_opens") == 0) & (F.col("inside") == 0)
    in_block = Window.partitionBy(*key).orderBy("at")
    above = in_block.rowsBetween(Window.unboundedPreceding, -1)
    followed = placed.where(~calm).withColumn("turned", F.coalesce(F.count_if(turns).over(above), F.lit(0)))
    fixed = F.last(F.when(fixes, F.col("opens").cast("int") + F.col("turned")), True).over(above)
    followed = followed.withColumn("inside", (F.coalesce(fixed, F.col("inside")) + F.col("turned")) % 2 == 1)
    followed = followed.withColumn("start", F.last(F.when(~F.col("inside") & F.col("opens"), F.struct("block", "at")), True).over(in_block))
    single = ~F.col("inside") & ~F.col("opens")
    record = lambda c: F.regexp_replace(c, "\r\\z", "").alias("record")

    # Lines of a block that belong together are put together where they are. Those before the first opening line of their block go on
    # with the last record opened in an earlier block; so only the first and the last part of a block can have to move.
    followed = followed.withColumn("single", single).withColumn("start", F.when(single, F.struct("block", "at")).otherwise(F.col("start")))
    parts = (followed.where(~F.col("single") | full).groupBy(*key, "start")
             .agg(F.sort_array(F.collect_list(F.struct("at", "value", "is_header"))).alias("lines"), F.any_value("single").alias("single")))
    parts = materialise(parts.select(*key, "start", "single", F.array_join("lines.value", "\n").alias("value"),
                                     F.exists("lines.is_header", lambda x: x).alias("is_header")), "parts")
    ends = parts.where("NOT single").groupBy(*key).agg(F.max("start").alias("start"), F.count_if(F.col("start").isNull()).alias("goes_on"))
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, 1)
    ends = materialise(ends.select(*key, F.last("start", True).over(earlier).alias("carried"), F.col("start").alias("_last"),
                                   (F.coalesce(F.max("goes_on").over(later), F.lit(0)) > 0).alias("next_goes_on")), "ends")
    moves = F.col("start").isNull() | F.coalesce((F.col("start") == F.col("_last")) & F.col("next_goes_on"), F.lit(False))
    parts = parts.join(ends, key, "left").withColumn("moves", moves)
    whole = [d.select("file", record("value"), "is_header") for d in (placed.where(calm & full), parts.where("NOT moves"))]
    apart = (parts.where("moves").groupBy("file", F.coalesce("start", "carried").alias("start"))
             .agg(F.sort_array(F.collect_list(F.struct("block", "value", "is_header"))).alias("lines")))
    joined = apart.select("file", record(F.array_join("lines.value", "\n")), F.exists("lines.is_header", lambda x: x).alias("is_header"))
    return reduce(DataFrame.unionByName, [*whole, joined])
