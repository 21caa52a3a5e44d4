"""Brown class-based bigrams: exchange clustering of words, class transitions and word emissions, scores of whole texts.

``P(word | before) = P(class | class before) * P(word | class)``. Every training word that occurs ``LEAST`` times or more has its own class.
Words with at least ``OWN`` of all tokens (at most 1 / OWN of them) are exchanged: in each round every word of one half looks, on the
executors, for the class that raises the likelihood of the bigrams most. A round that lowers it is taken back, and from then on half as many words
move at once; it ends when no part of the words raises it by its share of ``FLAT`` any more, or parts get smaller than 1 / ``MOST_PARTS``.
Each rarer word is then exchanged once, out of the class of the rest, by its counts to and from the classes of the words beside it; its class
stands in a Spark table and is joined. What is not seen ``LEAST`` times, and words that never stand beside a clustered one or a
text's end, share the class of the rest, which also holds the one place for unknown words: words seen once tell where new words come.

Texts are encoded once, as ranks of frequent words (with at least ``DIRECT`` of all tokens, at most 1 / DIRECT; sent to the tasks)
and places in a list of the text's own rarer words; all later passes read these numbers. All shares are relative, so any corpus is treated alike.

Smoothing: class transitions are mixed with the classes' shares as if ``PRIOR`` more tokens had been seen; in a class every known
word counts one more. A text ends with an end token, in a class of its own, which is also the context of the first word. Nulls and empty
texts have the end token alone. Every row gives one row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.llm.common import append, slices, words_of
from tabsync.storage import materialise, small_frame

OWN, DIRECT, LEAST, CLASSES, PRIOR, FLAT, MOST_PARTS = 2e-5, 1e-6, 2, 64, 5.0, 1e-4, 8
REST, ENDS = CLASSES, CLASSES + 1  # classes that no word is exchanged into
CONTEXTS = range(CLASSES + 2)
END = 0  # hash of the end token
#: Distinct words or pairs held by a task before it passes their counts on.
HELD = 500_000


def hash_of(word: bytes) -> int:
    return (xxhash.xxh3_64_intdigest(word) >> 1) + 1  # positive, never END


def numbered(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of the tokens of all texts, how many each text has, and the words; number 0 is the end of a text."""
    known: dict[bytes, int] = {}
    parts = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    flat = np.zeros(int(counts.sum()), np.int64)
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(counts) - 1] = False
    flat[inner] = np.fromiter((known.setdefault(w, len(known) + 1) for p in parts for w in p), np.int64, int(inner.sum()))
    return flat, counts, list(known)


def count_words(texts: DataFrame) -> DataFrame:
    """``h, n`` of every token of the texts (one column), the end token included."""
    out = T.StructType.fromDDL("h bigint, n bigint")

    def run(batches):
        held: dict[bytes, int] = {}
        ends = 0

        def passed():
            return pa.RecordBatch.from_arrays([pa.array([hash_of(w) for w in held], pa.int64()), pa.array(list(held.values()), pa.int64())], names=out.names)
        for batch in batches:
            for part in slices(batch, 0):
                flat, counts, words = numbered([t or "" for t in part.column(0).to_pylist()])
                ends += len(counts)
                for w, n in zip(words, np.bincount(flat, minlength=len(words) + 1)[1:].tolist()):
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield passed()
                    held.clear()
        yield passed()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends])], names=out.names)
    return texts.mapInArrow(run, out).groupBy("h").agg(F.sum("n").alias("n"))


@dataclass
class Frequent:
    """The words that tasks know: ranks from 1 by falling count; rank 0 is the end token."""
    hashes: np.ndarray  # by rank, END first
    counts: np.ndarray  # by rank
    own: int  # so many are exchanged

    def __post_init__(self):
        self.order = np.argsort(self.hashes)

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Ranks of words, -1 for others."""
        at = self.order[np.minimum(np.searchsorted(self.hashes, hashes, sorter=self.order), len(self.order) - 1)]
        return np.where(self.hashes[at] == hashes, at, -1)

    def units(self, codes: np.ndarray) -> np.ndarray:
        """Rank of each word that is exchanged, and one number more for all others."""
        return np.where((codes >= 0) & (codes <= self.own), codes, self.own + 1)


def encode(df: DataFrame, words: Frequent, text_col: str = "text") -> DataFrame:
    """``df`` with ``codes`` (packed: ranks, or -1, -2, ... for the text's rarer words) and ``rare`` (hashes of these) for the text."""
    shared = df.sparkSession.sparkContext.broadcast(words)  # at most 1 / DIRECT words

    def make():
        def run(texts):
            flat, counts, found = numbered(texts)
            hashes = np.array([END, *map(hash_of, found)], np.int64)
            codes = shared.value.ranks(hashes)[flat]
            ends, rare = np.cumsum(counts), np.flatnonzero(codes < 0)
            text = np.searchsorted(ends, rare, "right")
            own, at = np.unique(text * len(hashes) + flat[rare], return_inverse=True)
            offsets = np.searchsorted(own, np.arange(len(texts) + 1) * len(hashes))
            codes[rare] = offsets[text] - at - 1
            return [[_packed(codes[e - n:e]) for e, n in zip(ends.tolist(), counts.tolist())],
                    pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(hashes[own % len(hashes)]))]
        return run
    return append(df, text_col, "codes binary, rare array<bigint>", make).drop(text_col)


def _packed(codes: np.ndarray) -> bytes:
    """Codes as four runs of bytes, first all lowest ones, signs in the lowest bit: most of the runs are zeros, which compress."""
    return (codes << 1 ^ codes >> 63).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _flat(column) -> np.ndarray:
    """Codes of all texts of a batch one after the other; each ends with an end token, so what is before a text is one, too."""
    runs = [np.zeros((0, 4), np.uint8), *(np.frombuffer(c, np.uint8).reshape(4, -1).T for c in column.to_pylist())]
    codes = np.ascontiguousarray(np.concatenate(runs)).view("<i4").ravel().astype(np.int64)
    return codes >> 1 ^ -(codes & 1)


def count_pairs(codes: DataFrame, words: Frequent) -> DataFrame:
    """``a, b, n``: how often unit b follows unit a, from codes (one column)."""
    out, units = T.StructType.fromDDL("a int, b int, n bigint"), words.own + 2
    shared = codes.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        known, held, sums = shared.value, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def passed():
            return pa.RecordBatch.from_arrays([pa.array((held // units).astype(np.int32)), pa.array((held % units).astype(np.int32)), pa.array(sums)],
                                              names=out.names)
        for batch in batches:
            u = known.units(_flat(batch.column(0)))
            new, n = np.unique(np.append(0, u[:-1]) * units + u, return_counts=True)
            held, inverse = np.unique(np.concatenate((held, new)), return_inverse=True)
            sums = np.bincount(inverse, np.concatenate((sums, n)), len(held)).astype(np.int64)
            if len(held) > 4 * HELD:
                yield passed()
                held, sums = held[:0], sums[:0]
        yield passed()
    return codes.mapInArrow(run, out).groupBy("a", "b").agg(F.sum("n").alias("n"))


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_moves(right: np.ndarray, left: np.ndarray, self_n: np.ndarray, own: np.ndarray, n: np.ndarray,
               into: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For units with counts to (right) and from (left) every class, without the unit itself: best class and gain in likelihood.

    ``n`` (class before, class) holds all pairs, ``own`` the units' classes; only the first ``into`` classes are looked at (None: all).
    """
    k = len(n)
    target, gain = own.copy(), np.zeros(len(own))
    for i in range(len(own)):
        r, l, s, a = right[i], left[i], self_n[i], own[i]
        total_r, total_l = r.sum() + s, l.sum() + s
        m = n.copy()  # without the unit
        m[a] -= r
        m[:, a] -= l
        m[a, a] -= s
        rows, cols, diag = m.sum(1), m.sum(0), np.arange(k)
        change = (_f(m + r[None, :]) - _f(m)).sum(1) + (_f(m + l[:, None]) - _f(m)).sum(0)
        d = m[diag, diag]
        change += _f(d + r + l + s) - _f(d) - (_f(d + r) - _f(d)) - (_f(d + l) - _f(d))
        change -= _f(rows + total_r) - _f(rows) + _f(cols + total_l) - _f(cols)
        target[i] = int(np.argmax(change[:into]))
        gain[i] = change[target[i]] - change[a]
    return target, gain


def _moves(of: np.ndarray, matrix: np.ndarray, parts: int, turn: int):
    """Function from the pairs of some units (unit, side, other, n) to the best moves of those whose turn it is."""
    def moves(frame: pd.DataFrame) -> pd.DataFrame:
        numbers, at = np.unique(frame["unit"].to_numpy(), return_inverse=True)
        side, other, n = (frame[c].to_numpy() for c in ("side", "other", "n"))
        flat, alone = np.zeros((2, len(numbers), len(matrix))), np.zeros(len(numbers))
        same = numbers[at] == other
        np.add.at(flat, (side[~same], at[~same], of[other[~same]]), n[~same])
        np.add.at(alone, at[same & (side == 0)], n[same & (side == 0)])
        own = (numbers // 64 % parts == turn) & (of[numbers] < CLASSES)
        target, gain = best_moves(flat[0][own], flat[1][own], alone[own], of[numbers[own]], matrix, CLASSES)
        return pd.DataFrame({"unit": numbers[own], "target": target, "gain": gain})
    return moves


def likelihood(matrix: np.ndarray) -> float:
    """What classes add to the likelihood of bigrams."""
    return float(_f(matrix).sum() - _f(matrix.sum(0)).sum() - _f(matrix.sum(1)).sum())


def cluster(pairs: DataFrame, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit by exchange, and the pairs by class. ``pairs``: a, b, n of the end token, units 1 to ``own``, and the rest."""
    of = np.concatenate(([ENDS], np.arange(own) % CLASSES, [REST]))  # at first by rank
    sides = materialise(pairs.select(F.col("a").alias("unit"), F.lit(0).alias("side"), F.col("b").alias("other"), "n").union(
        pairs.select(F.col("b").alias("unit"), F.lit(1).alias("side"), F.col("a").alias("other"), "n")).where(F.col("unit").between(1, own)), "sides")
    matrix = class_pairs(pairs, of)
    best, parts, turn, quiet = likelihood(matrix), 2, 0, 0
    while own and quiet < parts <= MOST_PARTS:
        # All pairs of a unit have to be seen together; a unit has at most two rows per other unit.
        got = sides.groupBy(F.pmod("unit", F.lit(64)).alias("part")).applyInPandas(_moves(of, matrix, parts, turn), "unit int, target bigint, gain double")
        tried = of.copy()
        for r in got.where("gain > 1e-6").collect():
            tried[r["unit"]] = r["target"]
        pairs_now = class_pairs(pairs, tried)
        now, turn = likelihood(pairs_now), (turn + 1) % parts
        if now < best:  # too many at once, each by what the others were before
            parts, turn, quiet = 2 * parts, 0, 0
            continue
        quiet = 0 if now - best > FLAT / parts * abs(best) else quiet + 1
        best, of, matrix = now, tried, pairs_now
    return of, matrix


def class_pairs(pairs: DataFrame, of: np.ndarray) -> np.ndarray:
    """Pairs counted by class (class before, class)."""
    table = small_frame(pairs.sparkSession, list(enumerate(of.tolist())), "unit int, class int")
    side = lambda u, c: F.broadcast(table.select(F.col("unit").alias(u), F.col("class").alias(c)))  # noqa: E731  a row for each unit
    return _square(pairs.join(side("a", "ca"), "a").join(side("b", "cb"), "b").groupBy("ca", "cb").agg(F.sum("n").alias("n")))


def _square(counted: DataFrame) -> np.ndarray:
    out = np.zeros((CLASSES + 2, CLASSES + 2))
    for a, b, n in counted.collect():  # a row for each pair of classes
        out[a, b] = n
    return out


def count_contexts(coded: DataFrame, words: Frequent, of: np.ndarray) -> DataFrame:
    """``h, context, n`` of the words that are not exchanged: how often which class stands before (0 and up) and behind them
    (``CLASSES + 2`` and up); neighbours of the rest tell nothing. From ``codes, rare``."""
    out = T.StructType.fromDDL("h bigint, context int, n bigint")
    shared = coded.sparkSession.sparkContext.broadcast((words, of))

    def run(batches):
        known, classes = shared.value
        for batch in batches:
            for part in slices(batch, 0):
                lengths = np.array([len(c) // 4 for c in part.column(0).to_pylist()], np.int64)
                codes, rare = _flat(part.column(0)), part.column(1)
                cls = classes[known.units(codes)]
                at = np.flatnonzero(cls == REST)
                first = np.repeat(np.cumsum(pc.list_value_length(rare).to_numpy()) - pc.list_value_length(rare).to_numpy(), lengths)
                own = np.append(rare.flatten().to_numpy(), END)
                h = np.where(codes[at] < 0, own[np.where(codes[at] < 0, first[at] - codes[at] - 1, -1)], known.hashes[np.maximum(codes[at], 0)])
                before, behind = np.append(ENDS, cls)[at], cls[at + 1]  # an end follows each word
                distinct, no = np.unique(h, return_inverse=True)
                pair = np.concatenate((no[before != REST] * 2 * len(CONTEXTS) + before[before != REST],
                                       no[behind != REST] * 2 * len(CONTEXTS) + len(CONTEXTS) + behind[behind != REST]))
                pair, n = np.unique(pair, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(distinct[pair // (2 * len(CONTEXTS))]), pa.array((pair % (2 * len(CONTEXTS))).astype(np.int32)),
                                                  pa.array(n.astype(np.int64))], names=out.names)
    return coded.mapInArrow(run, out).groupBy("h", "context").agg(F.sum("n").alias("n"))


def placed(word: np.ndarray, context: np.ndarray, n: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Class of each word (numbered from 0, rows in order of words) that raises the likelihood of ``matrix`` most when its pairs come in."""
    size, behind = len(CONTEXTS), context >= len(CONTEXTS)
    # Row c: pairs of class c before each class; row size + c: of class c behind each.
    cells = np.concatenate((matrix[:, :CLASSES], matrix[:CLASSES].T))
    starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    gain = np.add.reduceat(_f(cells[context] + n[:, None]) - _f(cells)[context], starts)
    for mask, total in ((behind, matrix.sum(1)[:CLASSES]), (~behind, matrix.sum(0)[:CLASSES])):
        own = np.add.reduceat(np.where(mask, n, 0), starts)
        gain -= _f(total + own[:, None]) - _f(total)
    return np.argmax(gain, 1)


def place(contexts: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``h, class`` of words from ``h, context, n``."""
    of_word = contexts.groupBy("h").agg(F.collect_list(F.struct("context", "n")).alias("seen"))  # at most 2 * CLASSES + 3 each
    out = T.StructType.fromDDL("h bigint, class int")

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                word = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column(1)).to_numpy())
                seen = part.column(1).flatten()
                cls = placed(word, seen.field(0).to_numpy(), seen.field(1).to_numpy(), matrix)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cls.astype(np.int32))], names=out.names)
    return of_word.mapInArrow(run, out)


@dataclass
class Model:
    words: Frequent
    classes: np.ndarray  # of frequent words by rank
    transitions: np.ndarray  # log10 P(class | class before)
    room: np.ndarray  # log10 of what emissions of a class are divided by
    tokens: int
    types: int


def _known(batch, words: Frequent, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the texts of a batch (codes, n_rare, found), class and count of each token."""
    lengths = np.array([len(c) // 4 for c in batch.column(0).to_pylist()], np.int64)
    codes, n_rare, found = _flat(batch.column(0)), batch.column(1).to_numpy(), batch.column(2)
    base = np.cumsum(n_rare) - n_rare
    cls, n = np.full(int(n_rare.sum()) + 1, REST), np.zeros(int(n_rare.sum()) + 1, np.int64)
    of = np.repeat(base, pc.fill_null(pc.list_value_length(found), 0).to_numpy())
    seen = found.flatten()
    at = of + seen.field(0).to_numpy()
    n[at], cls[at] = seen.field(1).to_numpy(), seen.field(2).to_numpy()
    place = np.where(codes < 0, np.repeat(base, lengths) - codes - 1, -1)
    rank = np.maximum(codes, 0)
    return lengths, np.where(codes < 0, cls[place], classes[rank]), np.where(codes < 0, n[place], words.counts[rank])


def resolve(coded: DataFrame, rare: DataFrame) -> DataFrame:
    """``coded`` (with ``no``) with ``n_rare`` and ``found``: place, count and class of those of its rarer words that are known."""
    each = coded.where(F.size("rare") > 0).select("no", F.posexplode("rare").alias("k", "h"))
    # One number on the way: 28 bits of a place (texts have under 2 GB), 28 of a count (below DIRECT of 10^14 tokens), 7 of a class.
    one = F.shiftleft(F.col("k").cast("bigint"), 35) + F.shiftleft("n", 7) + F.col("class")
    found = each.join(rare, "h").groupBy("no").agg(F.collect_list(one).alias("found"))
    bits = lambda x, first, n: F.shiftright(x, first).bitwiseAND((1 << n) - 1)
    parts = F.transform("found", lambda x: F.struct(bits(x, 35, 28).cast("int").alias("k"), bits(x, 7, 28).alias("n"), bits(x, 0, 7).cast("int").alias("class")))
    return coded.withColumn("n_rare", F.size("rare")).drop("rare").join(found, "no", "left").withColumn("found", parts)


def fit(texts: DataFrame, training: str = "training") -> tuple[Model, DataFrame, DataFrame]:
    """From ``no, text`` and whether to learn from it, and any other columns: the model, ``h, n, class`` of all words that it does not
    hold itself, and the encoded texts with what is known of their words."""
    counts = materialise(count_words(texts.where(training).select("text")), "words")
    tokens, types = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens = tokens or 0
    direct = (F.col("n") >= max(1.0, DIRECT * tokens)) & (F.col("h") != END)
    frequent = sorted(((r["n"], r["h"]) for r in counts.where(direct).collect()), reverse=True)
    end_count = next((r["n"] for r in counts.where(F.col("h") == END).collect()), 0)
    n = np.array([end_count, *(c for c, _ in frequent)], np.int64)
    words = Frequent(np.array([END, *(h for _, h in frequent)], np.int64), n, int((n[1:] >= max(float(LEAST), OWN * tokens)).sum()))

    coded = materialise(encode(texts, words), "codes")
    learned = coded.where(training)
    pairs = materialise(count_pairs(learned.select("codes"), words), "pairs")
    of, matrix = cluster(pairs, words.own)
    contexts = count_contexts(learned.select("codes", "rare"), words, of)
    exchanged = small_frame(texts.sparkSession, [(h, c) for h, c in zip(words.hashes[1:words.own + 1].tolist(), of[1:-1].tolist())], "h bigint, own int")
    table = counts.where(F.col("h") != END).join(place(contexts, matrix), "h", "left").join(exchanged, "h", "left")
    table = materialise(table.select("h", "n", F.coalesce("own", F.when(F.col("n") >= LEAST, F.col("class")), F.lit(REST)).alias("class")), "classes")

    classes = np.full(len(n), ENDS)
    got = {r["h"]: r["class"] for r in table.where(direct).collect()}  # at most 1 / DIRECT
    classes[1:] = [got[h] for h in words.hashes[1:].tolist()]
    rare = table.where(~direct)
    resolved = materialise(resolve(coded, rare), "resolved")
    shared = texts.sparkSession.sparkContext.broadcast((words, classes))

    def by_class(batches):
        size, sums = len(CONTEXTS), np.zeros(len(CONTEXTS) ** 2, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                cls = _known(part, *shared.value)[1]
                sums += np.bincount(np.append(ENDS, cls[:-1]) * size + cls, minlength=size ** 2)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)), pa.array(sums[at])], names=["a", "b", "n"])
    matrix = _square(resolved.where(training).select("codes", "n_rare", "found").mapInArrow(by_class, "a int, b int, n bigint")
                     .groupBy("a", "b").agg(F.sum("n").alias("n")))
    members = np.zeros(CLASSES + 2)
    for cls, many in table.groupBy("class").count().collect():
        members[cls] = many
    members[[REST, ENDS]] += 1  # unknown words; the end token
    per_class = matrix.sum(0)
    prior = (per_class + 1) / (per_class.sum() + len(CONTEXTS))
    transitions = np.log10((matrix + PRIOR * prior) / (matrix.sum(1, keepdims=True) + PRIOR))
    return Model(words, classes, transitions, np.log10(np.maximum(per_class + members, 1)), int(tokens), int(types)), rare, resolved


RESULT = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def score(df: DataFrame, training: Column, text_col: str = "text") -> DataFrame:
    """``df`` without its text, with the columns of ``RESULT`` (the last two log10 probabilities); columns of the caller so named give way."""
    # The caller's columns travel as one, so that no name of theirs meets one of these.
    kept = [f"`{c}`" for c in df.columns if c != text_col and c not in RESULT]
    packed = df.select(F.struct(*kept, F.lit(0).alias("_")).alias("row"), F.col(f"`{text_col}`").alias("text"),
                       F.coalesce(training, F.lit(False)).alias("training"), F.monotonically_increasing_id().alias("no"))
    model, _, resolved = fit(packed)
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most 1 / DIRECT words
    out = T.StructType([resolved.schema["row"], *T.StructType.fromDDL("n_tokens bigint, n_known bigint, base_score double, score double").fields])

    def run(batches):
        m = shared.value
        base_room = np.log10(m.tokens + m.types + 1)
        for batch in batches:
            for part in slices(batch, 0):
                lengths, cls, n = _known(part, m.words, m.classes)
                starts, seen = np.cumsum(lengths) - lengths, np.log10(n + 1.0)
                own = m.transitions[np.append(ENDS, cls[:-1]), cls] + seen - m.room[cls]
                columns = (lengths, np.add.reduceat((n > 0).astype(np.int64), starts), np.add.reduceat(seen, starts) - lengths * base_room, np.add.reduceat(own, starts))
                yield pa.RecordBatch.from_arrays([part.column(3), *map(pa.array, columns)], names=out.names)
    scored = resolved.select("codes", "n_rare", "found", "row").mapInArrow(run, out)
    return scored.select(*[F.col(f"row.{c}") for c in kept], *[(F.lit(model.tokens).cast("bigint") if c == "train_tokens" else F.col(c)).alias(c) for c in RESULT])
