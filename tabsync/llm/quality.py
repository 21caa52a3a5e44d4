"""Quality rules: counts of a text against fixed limits, and a logistic regression over hashed word and character n-grams.

Features are the shares of hashed words, pairs of neighbouring words and characters by threes and fours in a text, each kind in
``2 ** BITS`` places. The regression learns from a sample of labelled rows, at most ``sample`` of each class, those of smallest hash
of the id. Features are made where the texts are; one task reads those of the sample (at most 4 * 2 ** BITS places a row, whatever the
length of the text) and returns the model. A fifth of the sample is held back: on it, with rows weighted so that the classes weigh as they do
among all labels, the score is calibrated to a probability (a logistic curve over the score). Scoring reads whole texts in Arrow batches;
texts whose probability of being good reaches ``KEEP`` stay.

Null and empty texts have no words and the score of a text without features. Labels that disagree on a document count as low; null labels
and labels without document are left out. Where one class has no row there is no model: the probability is null and the rules alone decide.
Every row gives one row, repeated or not. Columns of the caller named as the new ones give way to them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsync.llm.common import append, crc_of_id
from tabsync.llm.words import Words, split, window_hashes

BITS = 14
KINDS = 4
#: Probability of being good from which a text stays.
KEEP = 0.5
#: Limits of the rules: fewest words, and percent of words in windows that the text repeats.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rounds of training, and the weight of the squared weights.
STEPS, DECAY = 150, 1e-5
_MULTIPLY = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Model:
    """Weights of all places and the base (the score), and the curve from score to probability."""

    weights: np.ndarray
    base: float
    slope: float
    shift: float

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.base, self.slope, self.shift], self.weights]).astype("<f8").tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Model:
        values = np.frombuffer(data, "<f8")
        return Model(values[3:].copy(), *map(float, values[:3]))

    def probability(self, score: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * score + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in order, and where each text ends."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    return points, np.cumsum([len(t) for t in texts], dtype=np.int64)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])] if len(ends) else total[:0]


def _sets(points: np.ndarray, chars: str) -> np.ndarray:
    table = np.zeros(129, bool)
    table[[ord(c) for c in chars]] = True
    return table[np.minimum(points, 128)]


def repeated_words(found: Words, size: int = WINDOW) -> np.ndarray:
    """Which words stand in a window of ``size`` words that its text holds twice or more."""
    ends, hashes = window_hashes(found, size)
    order = np.argsort(hashes, kind="stable")
    here, ends = hashes[order], ends[order]
    text = np.searchsorted(found.ends, ends, "right")
    same = np.flatnonzero((here[1:] == here[:-1]) & (text[1:] == text[:-1]))
    equal = np.ones(len(same), bool)
    for back in range(size):
        equal &= found.ids[ends[same] - back] == found.ids[ends[same + 1] - back]
    if equal.all():
        twice = ends[np.union1d(same, same + 1)]
    else:  # different windows of one hash: compare the words themselves
        some = np.union1d(same, same + 1)
        rows = np.stack([text[some], *[found.ids[ends[some] - back] for back in range(size)]], 1)
        _, which, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        twice = ends[some[times[which.ravel()] > 1]]
    edge = np.zeros(len(found.ids) + 1, np.int64)
    np.add.at(edge, twice - size + 1, 1)
    np.add.at(edge, twice + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def counts(texts: list[str], data: list[bytes], found: Words, points: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The columns of ``COUNTS``: words, code points in words, symbols, lines with a word equal to an earlier one, words in repeated windows."""
    lines = [[line for line in d.split(b"\n") if line.strip()] for d in data]
    return [np.diff(found.ends, prepend=0), _sums(~_sets(points, SPACES), ends), _sums(_sets(points, SYMBOLS), ends),
            np.array([len(each) - len(set(each)) for each in lines], np.int64), _sums(repeated_words(found), found.ends)]


def features(found: Words, points: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every kind: places of all features in order, and where those of each text end."""
    hashes = np.array([zlib.crc32(w) for w in found.distinct.to_pylist()], np.uint32)[found.ids] if len(found.ids) else np.zeros(0, np.uint32)
    shift = np.uint32(32 - BITS)
    points = points.astype(np.uint32, copy=False)
    for kind, (symbols, bounds, size) in enumerate(((hashes, found.ends, 1), (hashes, found.ends, 2), (points, ends, 3), (points, ends, 4))):
        sizes = np.diff(bounds, prepend=0)
        many = max(0, len(symbols) - size + 1)
        mixed = np.zeros(many, np.uint32)
        for k in range(size):
            mixed = (mixed ^ symbols[k:k + many]) * _MULTIPLY
            mixed ^= mixed >> np.uint32(15)
        mixed = (mixed * _MULTIPLY) >> shift
        if size > 1:  # windows that reach into the next text are none
            inside = np.ones(many, bool)
            for k in range(1, size):
                over = bounds[:-1] - k
                inside[over[(over >= 0) & (over < many)]] = False
            mixed = mixed[inside]
        yield mixed + np.uint32(kind << BITS), np.cumsum(np.maximum(sizes - size + 1, 0))


def scores(model: Model, found: Words, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.full(len(ends), model.base)
    for places, bounds in features(found, points, ends):
        out += _sums(model.weights[places], bounds) / np.maximum(np.diff(bounds, prepend=0), 1)
    return out


def sparse(texts: list[str]) -> list[tuple[bytes, bytes]]:
    """Places and shares of the features of each text, as bytes."""
    found, (points, ends) = split([t.encode() for t in texts]), code_points(texts)
    rows: list[tuple[list, list]] = [([], []) for _ in texts]
    for places, bounds in features(found, points, ends):
        for row, begin, end in zip(rows, np.concatenate([[0], bounds[:-1]]), bounds, strict=True):
            own, times = np.unique(places[begin:end], return_counts=True)
            row[0].append(own)
            row[1].append(times / max(1, end - begin))
    return [(np.concatenate(p).astype("<u4").tobytes(), np.concatenate(v).astype("<f4").tobytes()) for p, v in rows]


def _regression(indices: np.ndarray, values: np.ndarray, offsets: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and base by accelerated gradient descent on the balanced logistic loss."""
    many, rows = KINDS << BITS, np.repeat(np.arange(len(good)), np.diff(offsets))
    mass = np.where(good == 1, 0.5 / max(1, (good == 1).sum()), 0.5 / max(1, (good == 0).sum()))
    kind = indices >> BITS
    # Each kind gets the same weight as the base, so that one step size suits all.
    norm = np.sqrt(np.bincount(kind, values ** 2 * mass[rows], KINDS))
    scaled = values / np.maximum(norm, 1e-9)[kind]

    def answer(w, base):
        return np.bincount(rows, scaled * w[indices], len(good)) + base

    rate = 4 / (KINDS + 1)
    w, base, w_old, base_old = np.zeros(many), 0.0, np.zeros(many), 0.0
    for step in range(STEPS):
        pull = step / (step + 3)
        ahead, base_ahead = w + pull * (w - w_old), base + pull * (base - base_old)
        off = (_logistic(answer(ahead, base_ahead)) - good) * mass
        w_old, base_old = w, base
        w = ahead - rate * (np.bincount(indices, scaled * off[rows], many) + DECAY * ahead)
        base = base_ahead - rate * off.sum()
    return w / np.repeat(np.maximum(norm, 1e-9), 1 << BITS), base


def _curve(score: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic curve over scores, by damped Newton steps with a weak pull to slope 1."""
    x, at = np.stack([score, np.ones(len(score))], 1), np.array([1.0, 0.0])
    weight = weight / max(weight.sum(), 1e-12)
    for _ in range(50):
        p = _logistic(x @ at)
        pull = 1e-3 * (at - [1.0, 0.0])
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (weight * (p - good)) + pull)
        at = at - np.clip(step, -2, 2)
    return float(max(at[0], 1e-3)), float(at[1])


def train(ids: list, places: list[bytes], shares: list[bytes], good: np.ndarray, held: np.ndarray, weight: np.ndarray) -> Model | None:
    """Model of a sample in the order of its ids; None where a class is missing."""
    order = np.lexsort((np.array([zlib.crc32(p) for p in places]), np.array(ids, np.int64)))
    data = [(np.frombuffer(places[i], "<u4").astype(np.int64), np.frombuffer(shares[i], "<f4").astype(float)) for i in order]
    good, held, weight = good[order].astype(float), held[order], weight[order]
    if len(set(good[~held])) < 2 or len(set(good[held])) < 2:
        held = np.zeros(len(good), bool)  # too few rows to hold any back: the curve is fitted on all
    if len(set(good.tolist())) < 2:
        return None
    learn = np.flatnonzero(~held)
    offsets = np.concatenate([[0], np.cumsum([len(data[i][0]) for i in learn])])
    weights, base = _regression(np.concatenate([data[i][0] for i in learn]), np.concatenate([data[i][1] for i in learn]), offsets, good[learn])
    score = np.array([values @ weights[at] + base for at, values in data])
    check = held if held.any() else np.ones(len(good), bool)
    slope, shift = _curve(score[check], good[check], weight[check])
    return Model(weights, base, slope, shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = 1500) -> Model | None:
    """Model learned from labelled rows, at most ``sample`` of each class."""
    if labels.schema[id_col].dataType != docs.schema[id_col].dataType:
        labels = labels.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.min((F.col(label_col) > 0).cast("int")).alias("good")))
    known = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"))
    marked = marked.join(known, "id", "left_semi")
    totals = {r["good"]: r["n"] for r in marked.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return None
    chosen = [marked.where(F.col("good") == c).orderBy(F.xxhash64("id"), "id").limit(sample) for c in (0, 1)]
    # At most 2 * sample ids: a proven bound for the broadcast.
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen[0].unionByName(chosen[1])), "id"))

    def make():
        return lambda texts: [list(column) for column in zip(*sparse(texts), strict=True)] if texts else [[], []]

    made = append(rows, "text", "places binary, shares binary", make).drop("text")
    # Rows of one id: one of them counts.
    one = (made.groupBy("id").agg(F.min_by(F.struct("good", "places", "shares"), F.struct("places", "shares")).alias("r"))
           .select("id", (crc_of_id("id") % 5 == 0).alias("held"), "r.*"))

    def learn(batches):
        table = pa.Table.from_batches(batches) if batches else None
        column = {n: table.column(n).to_pylist() for n in table.column_names} if table is not None and table.num_rows else None
        if column:
            good = np.array(column["good"])
            share = np.array([totals[c] / max(1, (good == c).sum()) for c in good.tolist()])
            ids = [zlib.crc32(str(i).encode()) for i in column["id"]]
            model = train(ids, column["places"], column["shares"], good, np.array(column["held"]), share)
            if model:
                yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], names=["model"])

    found = one.repartition(1).mapInArrow(lambda batches: learn(list(batches)), "model binary").collect()
    return Model.from_bytes(found[0]["model"]) if found else None


def rate(df: DataFrame, model: Model | None, text_col: str = "text", probability: str = "probability") -> DataFrame:
    """``df`` with the columns of ``COUNTS`` and the probability that the text is good."""
    state = model.to_bytes() if model else None

    def make():
        known = Model.from_bytes(state) if state else None

        def work(texts):
            data = [t.encode() for t in texts]
            found, (points, ends) = split(data), code_points(texts)
            chance = pa.array(known.probability(scores(known, found, points, ends))) if known else pa.nulls(len(texts), pa.float64())
            return [*[pa.array(c, pa.int64()) for c in counts(texts, data, found, points, ends)], chance]

        return work

    return append(df, text_col, ", ".join(f"{c} bigint" for c in COUNTS) + f", `{probability}` double", make)


def base_failed() -> Column:
    """Texts that the rules refuse: too few words, or too many of them in windows that the text repeats."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def kept(probability: str = "probability") -> Column:
    """Texts that pass the rules and whose probability reaches the threshold; without a model the rules decide."""
    return ~base_failed() & F.coalesce(F.col(probability) >= KEEP, F.lit(True))
