"""Operators over texts against plain forms of the same."""

import hashlib
import random
import re
import sys
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsync.llm import bpe, brown, chunks, decontaminate, records, toxicity

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ast'relvdm \n\t1é中.!\0 　"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=6))
def test_bpe_is_that_of_the_library(texts):
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    codec = bpe.codec_of(RANKS)
    ids = codec.encode(texts)
    assert ids == plain.encode_ordinary_batch(texts)
    assert [codec.decode(i, codec.ends(i).tolist()).decode() for i in ids] == texts


def test_bpe_query(result, docs, plain):
    got = result("op4_byte_bpe").set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text):
        ids = plain.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert tuple(got.loc[i, ["n_tokens", "ids_sha256", "decoded_sha256"]]) == want


def test_bpe_odd(odd, none, plain):
    got = bpe.encode(odd, RANKS)
    assert got.columns.count("ids") == 1 and got.count() == odd.count()
    for row, text in zip(bpe.decode(got, RANKS).collect(), [r.text for r in odd.collect()]):
        assert row.text == (text or "") and list(row.ids) == plain.encode_ordinary(text or "")
    assert bpe.encode(none, RANKS).count() == 0


def test_records(spark, result, docs, odd, none, tmp_path):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORDS)
    got, start = result("op8_records").sort_values("doc_id"), 0
    for row, (_, doc) in zip(got.itertuples(), docs.sort_values("doc_id").iterrows()):
        ids = np.array([*library.encode(doc.text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    manifest = records.write_records(odd, str(tmp_path / "odd"), WORDS, file_bytes=100)
    back = records.read_records(manifest, "doc_id bigint, n bigint", lambda i, s, ids: (i, len(ids))).collect()
    assert len(back) == odd.count() and manifest.count() > 1
    first = manifest.first()
    assert records.read_record(first.path, 0)[1][-1] == 2
    assert records.write_records(none, str(tmp_path / "none"), WORDS).count() == 0


def test_records_notice_damage():
    whole = records.frame(records.pack(7, np.arange(5)))
    for at in range(len(whole)):
        bad = whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1:]
        with pytest.raises(ValueError):
            records.unframe(bad[:12], lambda n: bad[12:12 + n])


def _hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, t in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        for w in {tuple(own[i:i + 10]) for i in range(max(1, len(own) - 9))} if own else ():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


def test_decontaminate_query(spark, result, docs):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    got = result("op6_decontaminate").set_index("doc_id")
    for i, text in list(zip(docs.doc_id, docs.text)):
        if len(text or "") < 4000:
            assert tuple(got.loc[i, ["n_words", "n_hit", "n_items", "items_sha256"]]) == _hits(text, items)
    assert got.contaminated.any() and not got.contaminated.all()


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_decontaminate_odd(spark, odd, none, block, monkeypatch):
    """The same hits whether the items fit one automaton or need several passes; spans are of the original text."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = [(1, "no id, at ALL"), (1, "word"), (2, "here-now"), (3, None), (None, "same"), (4, " ".join(f"w{i}" for i in range(14)))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    texts = spark.createDataFrame([(9, "x W1, w2 w3 w4 w5 w6 w7 w8 w9 w10! w11 y w0")], "doc_id bigint, text string")
    for row in decontaminate.find(odd.select("doc_id", "text").union(texts), bench).withColumn("n_hit", decontaminate.hit_words()).collect():
        want = _hits(row.text, [x for x in items if x[0] is not None])
        assert (row.n_words, row.n_hit, len(row["items"])) == want[:3]
        for s in row.spans:
            assert decontaminate.words(row.text[s.start:s.stop]) == decontaminate.words(row.text)[s["first"]:s["last"] + 1]
    assert decontaminate.find(none, bench).count() == 0 and decontaminate.find(odd, bench.limit(0)).where("size(items) > 0").count() == 0


def test_chunks(spark, odd, none):
    passage = "\n".join(f"line {i} of a passage that comes again and again" for i in range(12))
    long_line = "one line of many words " * 15
    rows = [(i, f"own {i} start\nown {i} more\n{passage}\nown {i} end\n{long_line}\nlast {i}") for i in range(6)]
    got = {r.doc_id: r for r in chunks.remove_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].text == rows[0][1] and got[0].n_removed == 0
    for i in range(1, 6):
        assert long_line not in got[i].text and got[i].text.count("passage") < 12
        assert all(x in got[i].text for x in (f"own {i} start", f"own {i} more", f"last {i}"))
    kept = {(r.doc_id, r.text) for r in chunks.remove_repeated(odd).collect()}
    assert kept == {(r.doc_id, r.text) for r in odd.collect()}
    assert chunks.remove_repeated(none).count() == 0


@pytest.mark.parametrize("n, words", [(3, 18), (5, 12), (6, 10), (10, 10), (60, 1), (3, 24), (1, 50)])
def test_chunks_whole_passage(spark, n, words):
    """A passage of over 50 words goes whole, however its lines are cut and whatever stands around it; blank lines inside go with it."""
    rows, passages = [], []
    for k in range(12):
        lines = [" ".join(f"p{k}.{i}.{j}" for j in range(words)) for i in range(n)]
        passages.append(lines)
        for d in range(2):
            own = [f"own {k} {d} {i}" for i in range(k % 4 + d)]
            rows.append((2 * k + d, "\n".join([*own, ("\n\n" if k % 2 else "\n").join(lines), f"end {k} {d}"])))
    got = {r.doc_id: r for r in chunks.remove_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k in range(12):
        assert got[2 * k].text == rows[2 * k][1] and got[2 * k].n_removed == 0
        assert got[2 * k + 1].text == "\n".join([*(f"own {k} 1 {i}" for i in range(k % 4 + 1)), f"end {k} 1"])


def test_chunks_are_every_repeated_run():
    """Lines that go are those of all runs of enough words that are also in a text before."""
    rng = np.random.default_rng(5)
    pool = [" ".join(f"w{i}.{j}" for j in range(rng.integers(0, 12))) for i in range(8)]
    for _ in range(300):
        one, two = ([pool[i] for i in rng.integers(0, 8, 12)] for _ in range(2))
        two = [x if i % 5 else f"own {i}" for i, x in enumerate(two)]
        seen = {c for _, c in chunks.chunks("\n".join(one))}
        gone = {no for no, c in chunks.chunks("\n".join(two)) if c in seen}
        want = set()
        for a in range(12):
            for b in range(a + 1, 13):
                if two[a] and two[b - 1] and sum(len(x.split()) for x in two[a:b]) >= chunks.LEAST and any(one[i:i + b - a] == two[a:b] for i in range(12)):
                    want.update(range(a, b))
        got = {i for no, (a, b) in enumerate(chunks.runs(two)) if no in gone for i in range(a, b)}
        assert got == want


def test_chunks_leave_short_pairs(spark):
    """Pairs of frequent short lines, blank ones among them, are not a passage; 24 words stay, 25 go, also without spaces between words."""
    few, enough, unspaced = " ".join("abcdefghijkl"), " ".join("mnopqrstuvwxy"), "一二三四五六七八九十" * 3
    shared = ["Un.\nAn ele.", "En lal eauoue.\nLes.", "\n\n", f"{few}\n{few}"]
    rows = [(i, f"own {i}\n{x}\nend {i}") for i, x in enumerate(x for x in shared for _ in range(40))]
    rows += [(1000 + i, f"own {i}\n{few}\n{enough}\nend {i}") for i in range(2)] + [(2000 + i, f"own {i}\n{unspaced}\n{unspaced[:20]}\nend {i}") for i in range(2)]
    got = {r.doc_id: r for r in chunks.remove_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[i].text == text and got[i].n_removed == 0 for i, text in rows if i % 1000 == 0 or i < 1000)
    assert got[1001].text == got[2001].text == "own 1\nend 1"


def test_chunks_keep_one_of_overlapping(spark):
    text = "\n".join(["the same ten words in a line over and over"] * 9)
    got = chunks.remove_repeated(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert got.text == "\n".join(text.split("\n")[:3])


def test_chunks_query(result, docs):
    """Against a plain form: first places of chunks in the order of ids."""
    seen, want = set(), {}
    for i, text in sorted(zip(docs.doc_id, docs.text)):
        own = dict(chunks.chunks(text)) if text else {}
        gone = {no for no, c in own.items() if c in seen}
        places = {}
        for no, c in own.items():
            if c in places:
                gone.add(no)
            places[c] = no
        seen.update(own.values())
        want[i] = (chunks.without(text, gone) if gone else text, len(gone))
    got = result("op5_line_chunks")
    assert {r.doc_id: (r.text, r.n_removed) for r in got.itertuples()} == want


def test_toxicity(spark, odd, none):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(900):
        text = list(rng.choice(words, 60))
        if i % 6 == 0:
            text[int(rng.integers(60))] = f"vile{rng.integers(1000)}"
        rows.append((i, " ".join(text), "en" if i % 2 else "de", int(i % 6 == 0)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int")
    model = toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"), F.col("doc_id") % 5 != 0)
    scored = toxicity.score(df, model).toPandas()
    held = scored[scored.doc_id % 5 == 0]
    assert ((held.score >= 0.5) == (held.toxic == 1)).mean() > 0.97
    again = toxicity.score(df.withColumnRenamed("lang", "other").withColumnRenamed("toxic", "score"), model).toPandas()
    assert np.allclose(again.sort_values("doc_id").score, scored.sort_values("doc_id").score)
    assert toxicity.score(odd, model).where("score >= 0 AND score <= 1").count() == odd.count() and toxicity.score(none, model).count() == 0
    empty = toxicity.fit(none, df.select("doc_id", "toxic").limit(0), F.lit(True))
    assert toxicity.score(odd, empty).where("score < 0.5").count() == odd.count()


def test_toxicity_learns_from_all_rows(spark):
    """A word that only toxic documents have counts wherever its documents stand; 3,000 rows of each class."""
    order = spark.range(6000).where("id % 2 = 1").selectExpr("id").orderBy(F.desc(F.xxhash64("id"))).limit(40)
    last = {r["id"] for r in order.collect()}
    rows = [(i, f"a{i % 7} b{i % 11} " + ("late" if i in last else "vile" if i % 2 else "kind"), i % 2) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"), F.lit(True))
    assert toxicity.hashes(b"late")[0] in model.keys
    scored = toxicity.score(spark.createDataFrame([("late",), ("kind",)], "text string"), model).toPandas()
    assert scored.score[0] > 0.5 > scored.score[1]


def counted_rounds(monkeypatch):
    """Rows that each round of training is given from now on; nothing is learned."""
    calls = []
    monkeypatch.setattr(toxicity, "learn_round", lambda coded, keys, params, weights: calls.append(coded.count()) or params)
    return calls


def test_toxicity_takes_all_rounds_over_many_rows(spark, monkeypatch):
    calls = counted_rounds(monkeypatch)
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "bad day").otherwise("good day").alias("text"), (1 - F.col("id") % 2).cast("int").alias("toxic"))
    toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"), F.lit(True))
    assert len(calls) == 8 and len(set(calls)) == 1 and calls[0] > 23_000


def test_toxicity_hashes_of_many_words():
    rng = np.random.default_rng(5)
    words = [bytes(rng.choice(list(b"ab.,*#xyz\xc3\xa9'("), n)) for n in (*range(1, 36), 100, 1000) for _ in range(40)]
    assert toxicity.hashes_of(words).tolist() == [list(toxicity.hashes(w)) for w in words] and toxicity.hashes_of([]).shape == (0, toxicity.PARTS)
    texts = ["one two one (three) two", "", "two four"]
    docs, found = toxicity.numbered(texts)
    assert [d.tolist() for d in docs] == [[0, 1, 0, 2, 1], [], [1, 3]] and found.tolist() == [list(toxicity.hashes(w)) for w in (b"one", b"two", b"(three)", b"four")]
    for text, (own, hashed) in zip(texts, toxicity.by_text(docs, found), strict=True):
        plain, alone = toxicity.numbered([text])
        assert own.tolist() == plain[0].tolist() and hashed.tolist() == alone.tolist()


def test_toxicity_gradients():
    """Learning must lower the loss; with no epochs the model is the start."""
    docs, found = toxicity.numbered([f"good fine {'bad' if i % 2 else 'nice'} day w{i % 7}" for i in range(80)])
    y = np.array([i % 2 for i in range(80)], float)
    model = toxicity.train(docs, found, y, epochs=15)
    p = model.score(toxicity.pool(docs, model.rows_of(found), model.projected(), 3))
    assert ((p > 0.5) == y).all()


def test_brown(spark, result, docs):
    got = result("op7_brown_classes").set_index("doc_id")
    rows = list(zip(docs.doc_id, docs.text))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = {i: [*brown.words_of(t or ""), None] for i, t in rows}
    counts: dict = {}
    for i, _ in rows:
        if not held[i]:
            for w in tokens[i]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, _ in rows:
        base = sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens[i])
        row = got.loc[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(tokens[i]), sum(w in counts for w in tokens[i]), n)
        assert abs(row.base_score - base) < 1e-6 * abs(base) and row.score < 0
    assert got[got.held_out].score.sum() > got[got.held_out].base_score.sum()


def _brown_words(model, rare):
    """Count and class of every training word by hash."""
    known = {h: (n, c) for h, n, c in zip(model.words.hashes.tolist(), model.words.counts.tolist(), model.classes.tolist())}
    return known | {r.h: (r.n, r["class"]) for r in rare.collect()}


@pytest.mark.parametrize("direct, own", [(brown.DIRECT, brown.OWN), (0.06, 0.08), (1.0, 1.0)])
def test_brown_scores_as_its_model_says(spark, monkeypatch, direct, own):
    """Whatever words tasks know or join: emissions of a class and transitions sum to 1, and a score is the sum of their logarithms."""
    monkeypatch.setattr(brown, "DIRECT", direct)
    monkeypatch.setattr(brown, "OWN", own)
    texts = ["a b c d e f g a b", "A b a b x y", None, "", "c d c d q a  b\tc", "new c a", "a b a b c d c d e e"]
    df = spark.createDataFrame([(i, t, i not in (2, 5)) for i, t in enumerate(texts)], "no bigint, text string, training boolean")
    model, rare, _ = brown.fit(df)
    known = _brown_words(model, rare)
    counts: dict = {}
    for i, t in enumerate(texts):
        for w in [*brown.words_of(t or ""), None] if i not in (2, 5) else []:
            h = brown.END if w is None else brown.hash_of(w)
            counts[h] = counts.get(h, 0) + 1
    assert {h: n for h, (n, _) in known.items()} == counts
    assert all(c == brown.REST for n, c in known.values() if n < brown.LEAST) and known[brown.END][1] == brown.ENDS
    assert np.allclose((10 ** model.transitions).sum(1), 1)
    mass = np.zeros(len(model.room))
    mass[brown.REST] = 1 / 10 ** model.room[brown.REST]  # the unknown
    for n, c in known.values():
        mass[c] += (n + 1) / 10 ** model.room[c]
    assert np.allclose(mass[mass > 0], 1)
    scored = {r.no: r for r in brown.score(df, F.col("training")).collect()}
    for i, t in enumerate(texts):
        want, before = 0.0, brown.ENDS
        for w in [*brown.words_of(t or ""), None]:
            n, c = known.get(brown.END if w is None else brown.hash_of(w), (0, brown.REST))
            want += model.transitions[before, c] + np.log10(n + 1) - model.room[c]
            before = c
        assert scored[i].score == pytest.approx(want, rel=1e-9)


def test_brown_places_words_where_the_likelihood_rises_most():
    rng, size = np.random.default_rng(3), len(brown.CONTEXTS)
    matrix = rng.integers(0, 50, (size, size)).astype(float)
    rows = sorted((w, c, int(n)) for w in range(5) for c, n in zip(rng.choice(2 * size, 9, False).tolist(), rng.integers(1, 30, 9)))
    got = brown.placed(*(np.array(x) for x in zip(*rows)), matrix)
    for w in range(5):
        tried = []
        for k in range(brown.CLASSES):
            m = matrix.copy()
            for _, c, n in [r for r in rows if r[0] == w]:
                m[(k, c - size) if c >= size else (c, k)] += n
            # Sums over neighbours grow by the same whatever the class.
            rise = lambda old, new: brown._f(new).sum() - brown._f(old).sum()
            behind, before = (sum(n for x, c, n in rows if x == w and (c >= size) == side) for side in (True, False))
            tried.append(rise(matrix, m) - rise(matrix[k].sum(), matrix[k].sum() + behind) - rise(matrix[:, k].sum(), matrix[:, k].sum() + before))
        assert got[w] == int(np.argmax(tried))


def test_brown_tells_languages_apart(spark):
    rnd = random.Random(1)
    texts = [" ".join(f"{'xy'[i % 2]}{min(int(rnd.expovariate(.02)), 400)}" for _ in range(300)) for i in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    held = brown.score(df, F.col("doc_id") < 40).where("doc_id >= 40").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (held[0] - held[1]) / held[2] > 0.15  # knowing the language is worth log10(2) at most


def test_brown_odd(spark, odd, none):
    got = brown.score(odd, F.col("doc_id").isNotNull())
    assert got.count() == odd.count() and brown.score(none, F.lit(True)).count() == 0
    clash = odd.withColumns({c: F.lit(c) for c in ("more", "log_n", "base", "known", "model", "hs", "ks", "no", "row", "score")})
    rows = brown.score(clash, F.lit(True)).collect()
    assert len(rows) == odd.count() and all((r.more, r.base, r.known, r.hs, r.no, r.row) == ("more", "base", "known", "hs", "no", "row") for r in rows)
    assert all(r.score < 0 for r in rows)


def test_exchange_finds_classes():
    """Words of two languages that never mix come apart."""
    n = np.zeros((4, 4))
    right, left = np.zeros((1, 4)), np.zeros((1, 4))
    n[0, 0], n[1, 1], n[2, 0], n[0, 2] = 100, 100, 20, 20
    right[0, 0], left[0, 0] = 20, 20
    target, gain = brown.best_moves(right, left, np.zeros(1), np.array([2]), n)
    assert gain[0] >= 0 and target[0] in (0, 2)


def test_records_encode_every_letter_before_marks_as_the_library_does():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    letters = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LM" and not 0x3400 < c < 0xD7A4 and not 0x17000 <= c]
    rnd = random.Random(8)
    texts = [f"{c}, a{c}. {c}b! {c.upper()}; {c}{c}?x" for c in letters]
    texts += ["".join(rnd.choice(letters + list(" ,.;:!?ab\u0307\u0301") * 200) for _ in range(rnd.randint(0, 30))) for _ in range(20_000)]
    encoder = records.encoder_of(public_tokenizers.path("word_bpe_49k.json"))
    for at in range(0, len(texts), 4096):
        part = texts[at:at + 4096]
        want = library.encode_batch(part, add_special_tokens=False)
        for text, mine, theirs in zip(part, encoder.encode(part), want, strict=True):
            assert mine.tolist() == theirs.ids, text
    assert encoder.encode(["\u0130,"])[0].tolist() == [328, 136, 229, 267]
