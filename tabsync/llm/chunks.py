"""Line dedup by content: every repeated run of lines of ``LEAST`` words or more goes, but for its first occurrence.

A chunk is a shortest run of whole lines that holds ``LEAST`` words: one from every line onward and one back from every line, each
beginning and ending with a line that is not blank. Chunks overlap, so a passage that two texts share is covered by chunks inside it from its
first line to its last, wherever it stands and however short its lines are, and what has fewer words than ``LEAST`` is in no chunk of its own.
No boundary is left to chance. Two letters of a script that writes no spaces count as a word.

Chunks of equal 128-bit hash are compared byte by byte with the first of them (smallest id, then text hash, then place) before
they are removed; the first stays, also where a later one of the same text overlaps it. Blank lines go if all that is next to them
on both sides goes. Null texts stay null, empty ones empty; null ids come last. Rows of equal id and text are one occurrence and keep the
same chunks. What is counted as removed are chunks, not lines.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabsync.llm.common import slices, small_batches
from tabsync.storage import materialise

LEAST = 25
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def words_in(line: str) -> int:
    return len(line.split()) + (0 if line.isascii() else len(_UNSPACED.findall(line)) // 2)


def runs(lines: list[str], least: int = LEAST) -> list[tuple[int, int]]:
    """First line of each chunk and the line behind its last, in order."""
    upto = np.append(0, np.cumsum(np.fromiter(map(words_in, lines), np.int64, len(lines))))
    at = np.flatnonzero(np.diff(upto))
    ends = np.searchsorted(upto, upto[at] + least)
    starts = np.searchsorted(upto, upto[at + 1] - least, "right") - 1
    onward = zip(at[ends < len(upto)].tolist(), ends[ends < len(upto)].tolist())
    back = zip(starts[starts >= 0].tolist(), (at[starts >= 0] + 1).tolist())
    return sorted({*onward, *back})


def hashes(text: str) -> list[tuple[int, bytes]]:
    """Number and hash of the chunks; each line is hashed once."""
    lines = text.split("\n")
    own = [xxhash.xxh3_128_digest(x.encode()) for x in lines]
    return [(no, xxhash.xxh3_128_digest(b"".join(own[a:b]))) for no, (a, b) in enumerate(runs(lines))]


def chunks(text: str) -> list[tuple[int, str]]:
    """Number and text of the chunks."""
    lines = text.split("\n")
    return [(no, "\n".join(lines[a:b])) for no, (a, b) in enumerate(runs(lines))]


def without(text: str, gone: set[int]) -> str:
    lines, first, out = text.split("\n"), {}, set()
    for no, (a, b) in enumerate(runs(lines)):
        if no in gone:  # what a kept chunk of the same content holds as well stays
            out.update(range(max(a, first.get("\n".join(lines[a:b]), 0)), b))
        else:
            first.setdefault("\n".join(lines[a:b]), b)
    full = [i for i, x in enumerate(lines) if x and not x.isspace()]
    for i, k in zip(full, full[1:]):
        if i in out and k in out:
            out.update(range(i + 1, k))
    return "\n".join(x for i, x in enumerate(lines) if i not in out)


def _exploded(df: DataFrame, schema: str, rows_of) -> DataFrame:
    """Rows ``id, th, ...`` made from each text (last column of ``df``) and what stands between."""
    out = T.StructType.fromDDL(schema)
    kinds, at = [to_arrow_type(f.dataType) for f in out.fields], len(df.columns) - 1

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                rows = [r for row in zip(*(c.to_pylist() for c in part.columns)) for r in rows_of(*row)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=out.names)
    return df.mapInArrow(run, out)


def remove_repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: str = "n_removed") -> DataFrame:
    """``df`` with repeated chunks taken out of the texts, and how many went."""
    small_batches(df.sparkSession)
    last = (1 << 63) - 1
    doc = (F.coalesce(F.col(id_col).cast("bigint"), F.lit(last)).alias("id"), F.xxhash64(text_col).alias("th"))
    texts = df.where(F.length(text_col) > 0).select(*doc, F.col(text_col).alias("text"))
    found = materialise(_exploded(texts, "id bigint, th bigint, no int, h binary", lambda i, th, t: [
        (i, th, no, h) for no, h in hashes(t)]), "chunks")
    place = F.struct("id", "th", "no")
    firsts = materialise(found.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").drop("last"), "firsts")
    hits = found.join(firsts, "h").select("id", "th", "no", "h", (place == F.col("first")).alias("is_first"))
    wanted = materialise(hits.groupBy("id", "th").agg(F.collect_set(F.struct("no", "h", "is_first")).alias("__hits")), "wanted")  # a row per document
    keyed = df.drop(removed).withColumns({"__id": doc[0], "__th": doc[1]})
    # Whole rows move once, to their hits; they are written, as they are read for the comparison and for the removal.
    marked = materialise(keyed.join(wanted.withColumnsRenamed({"id": "__id", "th": "__th"}), ["__id", "__th"], "left"), "marked")

    def of_doc(i, th, own, text):
        by_no = dict(chunks(text))
        return [(i, th, x["no"], x["h"], x["is_first"], by_no[x["no"]].encode()) for x in own]
    content = materialise(_exploded(marked.where("__hits IS NOT NULL").select("__id", "__th", "__hits", F.col(text_col)),
                                    "id bigint, th bigint, no int, h binary, is_first boolean, content binary", of_doc), "content")
    kept = content.where("is_first").select("h", F.col("content").alias("first_content")).dropDuplicates(["h"])
    # What is told from its first by its bytes alone stays: only equal hashes of different chunks come back from here.
    other = content.where("NOT is_first").join(kept, "h").where(F.col("content") != F.col("first_content"))
    stay = materialise(other.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(F.collect_set("no").alias("__stay")), "stay")
    repeated = F.transform(F.filter("__hits", lambda x: ~x["is_first"]), lambda x: x["no"])
    marked = marked.join(stay, ["__id", "__th"], "left")
    marked = marked.withColumn("__gone", F.array_except(F.coalesce(repeated, F.array().cast("array<int>")),
                                                        F.coalesce("__stay", F.array().cast("array<int>"))))
    marked = marked.withColumn(removed, F.size("__gone")).drop("__id", "__th", "__hits", "__stay")

    fields = [f for f in marked.schema.fields if f.name != "__gone"]
    where = [f.name for f in fields].index(text_col)

    def rebuild(batches):
        for whole in batches:
            for part in slices(whole, whole.schema.get_field_index(text_col)):
                texts = [without(t, set(g)) if g else t for t, g in zip(part.column(text_col).to_pylist(), part.column("__gone").to_pylist())]
                columns = [part.column(f.name) for f in fields]
                columns[where] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
    return marked.mapInArrow(rebuild, T.StructType(fields))
