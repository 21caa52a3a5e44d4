"""The queries of the operators of this folder: each over its whole table, as thin as its result allows."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsync.llm import (
    bpe, brown, chunks, decontaminate, forest, hilbert, hyperminhash, quality, records, runs, style_tree, toxicity, whitening,
)
from tabsync.llm.common import crc_of_id, read
from tabsync.storage import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHARDS = 40


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_hilbert_shards(spark, d):
    """All documents in 40 runs of the Hilbert curve over language, source and length."""
    docs = read(spark, d, "documents", "doc_id", "text", "lang", "source")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", "lang", "source", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.char_length(text).alias("chars"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    dims = {"lang": F.col("lang"), "source": F.col("source"), "chars": F.col("chars")}
    placed = hilbert.shard(narrow, dims, SHARDS, ("doc_id", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


@query
def op2_site_style_tree(spark, d):
    found = style_tree.extract(read(spark, d, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op3_projection_forest(spark, d):
    """20 nearest of every vector whose id is divisible by 20, among all others."""
    found = forest.nearest(read(spark, d, "embeddings", "vec_id", "embedding"), 20, F.col("id") % 20 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("vec").alias("vec_id"), "score")


@query
def op4_byte_bpe(spark, d):
    docs = read(spark, d, "documents", "doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), outputs=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


@query
def op5_line_chunks(spark, d):
    return chunks.remove_repeated(read(spark, d, "documents", "doc_id", "text"))


@query
def op6_decontaminate(spark, d):
    found = decontaminate.find(read(spark, d, "documents", "doc_id", "text"), read(spark, d, "benchmark", "item_id", "text"))
    n_hit = decontaminate.hit_words()
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        decontaminate.items_digest().alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query
def op7_brown_classes(spark, d):
    """Learned from documents whose crc32 of the id leaves no 2 when divided by 7, scored over all."""
    held_out = F.coalesce(crc_of_id("doc_id") % 7 == 2, F.lit(False))
    return brown.score(read(spark, d, "documents", "doc_id", "text").withColumn("held_out", held_out), ~F.col("held_out"))


@query
def op8_records(spark, d):
    """Records written to the shared folder and read back, every checksum tested."""
    docs = read(spark, d, "documents", "doc_id", "text")
    manifest = records.write_records(docs, new_path(spark, "token-records"), public_tokenizers.path("word_bpe_49k.json"))
    return records.read_records(manifest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
                                lambda doc_id, start, ids: (doc_id, start, len(ids), zlib.crc32(ids.tobytes())))


@query
def op9_toxicity(spark, d):
    """Learned from labelled documents whose crc32 of the id is no multiple of 5."""
    docs, labels = read(spark, d, "documents", "doc_id", "text", "lang"), read(spark, d, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labels, crc_of_id("doc_id") % 5 != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (crc_of_id("doc_id") % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        toxicity.rejects(model).alias("rejected"))


@query
def op10_hyperminhash(spark, d):
    return hyperminhash.near_duplicates(read(spark, d, "documents", "doc_id", "text"), threshold=85)


@query
def op11_word_runs(spark, d):
    """Runs of at least 6 words and 4 periods. One document in ten, by the crc32 of its id, is made periodic from a word on."""
    h = crc_of_id("doc_id")
    docs = read(spark, d, "documents", "doc_id", "text").withColumn("w", F.when(h % 10 == 0, runs.words_column(F.col("text"))))
    g, n, w = F.floor(h / 10).cast("bigint"), F.size("w"), F.col("w")
    docs = docs.withColumn("a", F.when(n > 0, (g % n).cast("int"))).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    period = F.slice(w, F.col("a") + 1, F.col("p"))
    longer = F.concat(F.slice(w, F.lit(1), F.col("a")), F.flatten(F.array_repeat(period, F.ceil((n - F.col("a")) / F.col("p")).cast("int"))))
    text = F.coalesce(F.when(n > 0, F.array_join(F.slice(longer, F.lit(1), n), " ")), F.col("text"))
    found = runs.find(docs.select("doc_id", text.alias("text"))).withColumn("best", runs.longest("runs"))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
                        runs.digest("runs").alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op12_quality_ngrams(spark, d):
    docs = read(spark, d, "documents", "doc_id", "text")
    model = quality.fit(docs, read(spark, d, "labels", "doc_id", "quality"))
    return quality.rate(docs, model).select("doc_id", *quality.COUNTS, quality.base_failed().alias("base_failed"), quality.kept().alias("kept"), "probability")


@query
def op13_feast_whitening(spark, d):
    """Whitened by the four largest components of the distinct vectors in steps of 1/256."""
    return whitening.whiten(read(spark, d, "embeddings", "vec_id", "embedding"), 4, keep=("vec_id",))


#: No operator of this folder has a result that SQL expresses; tests hold each query against a plain or exhaustive form.
ORACLE_SQL: dict[str, str] = {}
