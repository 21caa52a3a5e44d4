"""A corpus on its way to training: toxic documents go, repeated lines go, near copies go, leaked ones go, the rest becomes token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents; a stage that changes texts corrects n_chars.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsync.llm import bpe, chunks, decontaminate, hyperminhash, toxicity
from tabsync.llm.common import crc_of_id, read
from tabsync.storage import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL expresses no stage: a trained network, rolling hashes, an automaton and merges by rank. tests/llm holds each against a plain form.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that reach the threshold of their language go; the model learns from documents that are not held out."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"), crc_of_id("doc_id") % 5 != 0)
    return toxicity.score(docs, model, out="__score").where(~toxicity.rejects(model, "__score")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks go but for the first; a document left without text goes too, one that had none stays."""
    found = chunks.remove_repeated(docs.select(*COLUMNS), removed="__removed")
    left = found.where((F.col("__removed") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.when(F.col("__removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group stays (five-word shingles, similarity 0.8)."""
    groups = hyperminhash.near_duplicates(docs, threshold=80)
    gone = materialise(groups.where(~F.col("kept")).select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate.find(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.where(F.size("items") == 0).select(*COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the byte offsets at which they end, whose decoding is the text."""
    return bpe.encode(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), outputs=("ids", "ends")).drop("text", "n_chars")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_copies),
          ("decontamination", drop_leaked), ("byte_bpe", to_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
