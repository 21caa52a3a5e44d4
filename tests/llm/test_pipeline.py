"""Every stage of the pipeline against a plain form, on its own input."""

import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_other_operators import lower_ascii, plain_components

import corpus_pipeline
from tabsync.llm import bpe, toxicity
from tabsync.llm.common import crc_of_id
from tabsync.storage import materialise

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def steps(spark):
    """(stage, its input, its output) as pandas frames, by id."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, SMALL), name)
        out[name] = docs.toPandas().set_index("doc_id"), after.toPandas().set_index("doc_id")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == list(corpus_pipeline.COLUMNS)
        docs = after
    return out


def test_toxic_documents_go(spark, steps):
    """Those that the model of these labels rejects; it learns the same again. Held-out accuracy is tested with the operator."""
    before, after = steps["toxicity"]
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, crc_of_id("doc_id") % 5 != 0)
    scored = toxicity.score(docs, model).withColumn("gone", toxicity.rejects(model)).toPandas().set_index("doc_id")
    assert sorted(after.index) == sorted(scored.index[~scored.gone]) and (after.text == before.text[after.index]).all()


def test_toxicity_takes_all_rounds_over_many_rows(spark, tmp_path, monkeypatch):
    """Each of 8 rounds is given all rows that are learned from, also beyond 20,000 of them."""
    calls = []
    monkeypatch.setattr(toxicity, "learn_round", lambda coded, keys, params, weights: calls.append(coded.count()) or params)
    bad = F.col("doc_id") % 2 == 0
    docs = spark.range(40_000).withColumnRenamed("id", "doc_id").select("doc_id", F.when(bad, "bad day").otherwise("good day").alias("text"), F.lit("en").alias("lang"),
                                                                        F.lit("s").alias("source"), F.lit(8).cast("bigint").alias("n_chars"))
    docs.select("doc_id", F.lit(1).alias("quality"), bad.cast("int").alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).columns == list(corpus_pipeline.COLUMNS)
    learned = docs.where((crc_of_id("doc_id") % 5 != 0) & (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) != 0)).count()
    assert calls == [learned] * 8 and learned > 20_000


def windows(text):
    """Shortest runs of whole lines from every line on that hold 25 words."""
    lines = text.split("\n")
    sizes = [len(x.split()) for x in lines]
    for a, n in enumerate(sizes):
        b = a
        while n and b < len(lines) and sum(sizes[a:b + 1]) < 25:
            b += 1
        if n and b < len(lines):
            yield "\n".join(lines[a:b + 1])


def test_repeated_lines_go(steps):
    before, after = steps["line_dedup"]
    seen, repeated = {}, set()
    for i in sorted(before.index):
        for w in windows(before.text[i] or ""):
            if seen.setdefault(w, i) != i:
                repeated.add(i)
    first: dict[str, int] = {}
    for i in sorted(after.index):
        for w in windows(after.text[i] or ""):
            assert first.setdefault(w, i) == i  # nothing of 25 words in whole lines is left twice
    for i in before.index:
        if i not in repeated and len(set(windows(before.text[i] or ""))) == len(list(windows(before.text[i] or ""))):
            assert after.text[i] == before.text[i] and after.n_chars[i] == before.n_chars[i]
    assert all(after.n_chars[i] == len(after.text[i]) for i in after.index if after.text[i] != before.text[i])


def test_one_of_each_group_of_near_copies_stays(steps):
    before, after = steps["near_dedup"]
    groups = plain_components(before.text.to_dict(), 80)
    assert sorted(after.index) == sorted(i for i, (_, top) in groups.items() if top == i)


def test_leaked_documents_go(spark, steps):
    before, after = steps["decontamination"]
    items = [WORD.findall(lower_ascii(t or "")) for t in spark.read.parquet(f"{SMALL}/benchmark.parquet").toPandas().text]
    wanted = {tuple(w[k:k + 10]) for w in items if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in wanted}

    def leaked(text):
        words = WORD.findall(lower_ascii(text or ""))
        return any(tuple(words[k:k + n]) in wanted for n in sizes for k in range(len(words) - n + 1))
    assert sorted(after.index) == sorted(i for i in before.index if not leaked(before.text[i]))


def test_tokens_are_those_of_the_library(steps):
    before, after = steps["byte_bpe"]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    assert sorted(after.index) == sorted(before.index)
    for i in after.index:
        assert list(after.ids[i]) == plain.encode_ordinary(before.text[i] or "") and plain.decode_bytes(list(after.ids[i])) == (before.text[i] or "").encode()


def test_stages_bear_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "word", "en", "s", 4), (3, "word", "en", "s", 4), (None, "no id " * 40, "de", None, 240),
            (5, "long words " * 20_000, "en", "s", 220_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for df in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            df = materialise(stage(spark, df, SMALL), name)
        assert df.count() <= len(rows)
