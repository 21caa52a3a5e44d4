"""Toxicity: a convolutional text classifier over hashed words, trained on every labelled row, scoring every whole text.

A word is the sum of rows of an embedding table, chosen by crc32 of the word and of its beginnings. Filters of several widths slide over the
words; each filter's largest answer in the text goes into a logistic unit. Max pooling sees every
position, so a long text is judged as a whole. Training reads all labelled rows in rounds: each task goes on from the model of the
round before over its own rows, batch by batch, and what the tasks have learned is averaged, a row of the table by how often it was
met. A fifth of the rows is held back to calibrate the score, so that 0.5 separates best, and to set one threshold per language; these
are found from counts of all of them. Labels, language, source and id never enter a score.

Scoring multiplies the table with the filters once, after which a filter answer is a sum of rows.
Null and empty texts get the score of a text without words. Every row gives one row. Labels that
disagree on a document count as toxic; null labels and labels without document are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsync.llm.common import append, words_of
from tabsync.storage import materialise, materialise_counted

#: Rows of the embedding table: at most this many hashes, those found in most labelled documents.
ROWS = 1 << 16
#: A hash counts when this many labelled documents have it; other words look like no word at all.
LEAST = 5
#: Rounds over all labelled rows, however many there are.
ROUNDS = 8
#: Rows that a task learns from at least, where there are so many: the more steps it goes, the less is lost by averaging.
TASK_ROWS = 5000
#: Table rows that are averaged together, and steps of an answer that are counted apart to find thresholds.
BLOCK, STEPS = 4096, 256
WIDTHS, FILTERS, DIM, BATCH, RATE, SEED = (1, 2, 3), 8, 12, 64, 0.01, 7
#: The table learns slower than the filters: most of its rows are seen rarely.
TABLE_RATE = 0.1
#: Lengths in bytes of the beginnings that count beside the whole word.
PREFIXES = (4, 5, 6)
PARTS = 1 + len(PREFIXES)
_STRIP = b".,;:!?\"'()[]{}*$%&#"
_INSIDE = ~np.isin(np.arange(256), np.frombuffer(_STRIP, np.uint8))
#: The table of crc32, and what a start with the length of a beginning changes in its checksum.
_TABLE = np.array([zlib.crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)
_SEEDS = {k: zlib.crc32(bytes(k + 1), k) ^ zlib.crc32(bytes(k + 1)) for k in PREFIXES}


def hashes(word: bytes) -> tuple[int, ...]:
    """crc32 of a word and of its beginnings (0 where it is no longer than that)."""
    w = word.strip(_STRIP) or word
    return zlib.crc32(w), *(zlib.crc32(w[:k] + b"*", k) if len(w) > k else 0 for k in PREFIXES)


def hashes_of(words: list[bytes]) -> np.ndarray:
    """:func:`hashes` of many words that are not empty, a row for each: one step of the checksum over all of them at once."""
    if not words:
        return np.zeros((0, PARTS), np.uint32)
    flat, sizes = np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
    first, place = np.cumsum(sizes) - sizes, np.arange(len(flat))
    begin = np.minimum.reduceat(np.where(_INSIDE[flat], place, len(flat)), first)
    end = np.maximum.reduceat(np.where(_INSIDE[flat], place, -1), first) + 1
    begin, end = np.where(end > 0, begin, first), np.where(end > 0, end, first + sizes)
    long = np.flatnonzero(end - begin > 32)
    size = end - begin
    size[long] = 0
    order = np.argsort(-size, kind="stable")
    begin, left = begin[order], len(words) - np.searchsorted(size[order][::-1], np.arange(34))  # left[i]: words of i bytes or more
    state, out = np.full(len(words), 0xFFFFFFFF, np.uint32), np.zeros((len(words), PARTS), np.uint32)
    for i in range(int(size.max())):
        n = left[i + 1]
        state[:n] = _step(state[:n], flat[begin[:n] + i])
        if i + 1 in PREFIXES:
            n, k = left[i + 2], i + 1
            out[:n, 1 + PREFIXES.index(k)] = _step(state[:n], 42) ^ np.uint32(0xFFFFFFFF ^ _SEEDS[k])
    out[:, 0] = ~state
    found = np.empty_like(out)
    found[order] = out
    for i in long:
        found[i] = hashes(words[i])
    return found


def _step(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _TABLE[(state ^ byte) & 0xFF] ^ (state >> 8)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def numbered(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Each text as numbers of distinct words, and the hashes of those words."""
    known = _Numbers()
    parts = [words_of(t) for t in texts]
    docs = [np.fromiter(map(known.__getitem__, p), np.int32, len(p)) for p in parts]
    return docs, hashes_of(list(known))


def by_text(docs: list[np.ndarray], found: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each document by numbers of its own words, in the order of their first places, and the hashes of these."""
    out = []
    for d in docs:
        used, first, inverse = np.unique(d, return_index=True, return_inverse=True)
        order = np.argsort(first)
        number = np.empty(len(used), np.int32)
        number[order] = np.arange(len(used))
        out.append((number[inverse], found[used[order]]))
    return out


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes that have a row
    table: np.ndarray  # (rows + 1, dim); the last row is nothing: unknown hashes, and the places around a text
    filters: dict[int, np.ndarray]  # width -> (width, dim, n)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)  # calibration
    thresholds: dict[str, float] = field(default_factory=dict)  # by language; "" for all others

    def projected(self) -> list[tuple[int, list[np.ndarray], np.ndarray]]:
        """Per width: the table times each place of the filters, so that an answer is a sum of rows."""
        return [(k, [np.ascontiguousarray(self.table @ w[j]).astype(np.float32) for j in range(k)], self.bias[k].astype(np.float32))
                for k, w in self.filters.items()]

    def rows_of(self, found: np.ndarray) -> np.ndarray:
        return rows_of(self.keys, found)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled.astype(np.float64) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * z + self.scale[1], -60, 60)))


def rows_of(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Row of each hash, the last row for unknown ones."""
    at = np.minimum(np.searchsorted(keys, found), max(0, len(keys) - 1))
    return np.where(keys[at] == found, at, len(keys)) if len(keys) else np.zeros(found.shape, np.int64)


def padded(docs: list[np.ndarray], width: int, nothing: int) -> tuple[np.ndarray, np.ndarray]:
    """All documents in one array, with ``width - 1`` times nothing before each and behind the last; where each starts."""
    pad = np.full(max(1, width - 1), nothing, np.int32)
    parts = [x for d in docs for x in (pad, d)] + [pad]
    return np.concatenate(parts), np.cumsum([0] + [len(pad) + len(d) for d in docs[:-1]])


def pool(docs: list[np.ndarray], word_rows: np.ndarray, projected, width: int) -> np.ndarray:
    """Largest answer of each filter in each document; ``word_rows``: table rows of each numbered word."""
    ids, starts = padded(docs, width, len(word_rows))
    out = []
    for k, tables, bias in projected:
        n = len(ids) - (k - 1)
        answers = None
        for j, t in enumerate(tables):
            own = sum(t.take(word_rows[:, i], axis=0) for i in range(word_rows.shape[1]))
            own = np.vstack((own, np.zeros((1, t.shape[1]), t.dtype))).take(ids[j:n + j], axis=0)
            answers = own if answers is None else np.add(answers, own, out=answers)
        out.append(np.maximum(np.maximum.reduceat(answers, starts, axis=0) + bias, 0))
    return np.hstack(out)


def start(keys: np.ndarray, seen: np.ndarray, totals: np.ndarray, widths=WIDTHS, filters: int = FILTERS, dim: int = DIM,
          seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters to begin with. The first coordinate of a hash is its shrunken log ratio between the classes, the rest is random.

    ``keys`` are sorted, ``seen`` has the number of documents of each class (0, 1) that have them, ``totals`` of all documents.
    """
    rng, total = np.random.default_rng(seed), seen.sum(0)
    share = (seen + 0.5) / (np.asarray(totals)[:, None] + 1)
    table = np.vstack((rng.normal(0, 0.05, (len(keys), dim)), np.zeros((1, dim))))
    table[:-1, 0] = np.log(share[1] / share[0]) * total / (total + 20)
    params = {"table": table, "out": np.abs(rng.normal(0, 0.3, filters * len(widths))), "out_bias": np.zeros(1)}
    for k in widths:
        w = rng.normal(0, 0.1, (k, dim, filters))
        w[:, 0] += 0.5
        params[f"w{k}"], params[f"b{k}"] = w, np.zeros(filters)
    return params


class Learner:
    """Adam on the logistic loss, changing ``params`` in place; ``met`` counts the steps that had each row of the table."""

    def __init__(self, params: dict[str, np.ndarray], weights: np.ndarray, rate: float = RATE):
        self.params, self.weights, self.rate, self.step, self.rows = params, weights, rate, 0, 0
        self.moments = {n: (np.zeros_like(p), np.zeros_like(p)) for n, p in params.items()}
        self.widths = tuple(k for k in range(1, 9) if f"w{k}" in params)
        self.met = np.zeros(len(params["table"]), np.int64)

    def learn(self, docs: list[np.ndarray], word_rows: np.ndarray, labels: np.ndarray) -> None:
        """One step. ``docs``: numbers of words, whose table rows are those of ``word_rows``."""
        params, moments, widths, width = self.params, self.moments, self.widths, max(self.widths)
        nothing, dim = len(params["table"]) - 1, params["table"].shape[1]
        filters = params[f"b{width}"].shape[0]
        ids, starts = padded(docs, width, len(word_rows))
        used, local = np.unique(ids, return_inverse=True)  # the last one is the place around texts
        parts = np.vstack((word_rows[used[:-1]], np.full((1, word_rows.shape[1]), nothing)))
        rows = sum(params["table"].take(parts[:, j], axis=0) for j in range(parts.shape[1]))
        self.step, self.rows = self.step + 1, self.rows + len(docs)
        grads, pooled, places = {n: np.zeros_like(p) for n, p in params.items() if n != "table"}, [], []
        for k in widths:
            n = len(ids) - (k - 1)
            w = params[f"w{k}"]
            answers = sum((rows @ w[j]).take(local[j:n + j], axis=0) for j in range(k)) + params[f"b{k}"]
            best = np.maximum.reduceat(answers, starts, axis=0)
            lengths = np.diff(np.append(starts, n))
            spots, f = np.divmod(np.flatnonzero(answers == np.repeat(best, lengths, axis=0))[::-1], filters)
            where = np.empty(best.shape, np.int64)  # the first place of the largest answer
            where[np.repeat(np.arange(len(docs)), lengths)[spots], f] = spots
            pooled.append(np.maximum(best, 0))
            places.append((where, best > 0))
        x = np.hstack(pooled)
        p = 1 / (1 + np.exp(-np.clip(x @ params["out"] + params["out_bias"], -30, 30)))
        err = (p - labels) * self.weights[labels.astype(int)] / len(docs)
        grads["out"], grads["out_bias"] = x.T @ err, np.array([err.sum()])
        back, moved = np.outer(err, params["out"]), np.zeros_like(rows)
        for i, k in enumerate(widths):
            where, live = places[i]
            g = back[:, i * filters:(i + 1) * filters] * live
            grads[f"b{k}"] = g.sum(0)
            for j in range(k):
                at_j = local[where + j]
                grads[f"w{k}"][j] = np.einsum("bfd,bf->df", rows[at_j], g)
                for f in range(filters):
                    np.add.at(moved, at_j[:, f], g[:, f, None] * params[f"w{k}"][j][:, f])
        touched, inside = np.unique(parts, return_inverse=True)
        at = np.flatnonzero(moved.any(1))  # words that gave a largest answer
        inside, each = inside.reshape(parts.shape)[at].ravel(), np.repeat(moved[at], parts.shape[1], axis=0)
        spread = np.stack([np.bincount(inside, each[:, d], len(touched)) for d in range(dim)], 1)
        spread[touched == nothing] = 0
        self.met[touched] += 1
        for name, g in grads.items():
            m, v = moments[name]
            m[:], v[:] = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            params[name] -= self._move(m, v)
        m, v = (x.take(touched, axis=0) for x in moments["table"])
        m *= 0.9
        v *= 0.999
        live = np.flatnonzero(spread.any(1))
        m[live] += 0.1 * spread[live]
        v[live] += 0.001 * spread[live] * spread[live]
        moments["table"][0][touched], moments["table"][1][touched] = m, v
        params["table"][touched] -= self._move(m, v, TABLE_RATE)

    def _move(self, m: np.ndarray, v: np.ndarray, share: float = 1) -> np.ndarray:
        spread = v / (1 - 0.999**self.step)
        np.sqrt(spread, out=spread)
        spread += 1e-8
        move = m / (1 - 0.9**self.step)
        move *= self.rate * share
        move /= spread
        return move


def class_weights(totals) -> np.ndarray:
    """Weights of rows of class 0 and 1 that make both classes count the same."""
    return sum(totals) * 0.5 / np.maximum(1, np.asarray(totals, float))


def model_of(keys: np.ndarray, params: dict[str, np.ndarray]) -> Model:
    widths = [k for k in range(1, 9) if f"w{k}" in params]
    return Model(keys, params["table"], {k: params[f"w{k}"] for k in widths}, {k: params[f"b{k}"] for k in widths}, params["out"], float(params["out_bias"][0]))


def train(docs: list[np.ndarray], found: np.ndarray, labels: np.ndarray, widths=WIDTHS, filters: int = FILTERS, dim: int = DIM,
          epochs: int = 8, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Model:
    """A model of rows that are at hand, classes weighted equally. Deterministic for given rows.

    ``docs``: numbers of words, whose hashes are the rows of ``found``.
    """
    keys, inverse = np.unique(found, return_inverse=True)
    inverse = inverse.reshape(found.shape)
    seen = np.zeros((2, len(keys)))
    for d, y in zip(docs, labels):
        seen[int(y), np.unique(inverse[np.unique(d)])] += 1
    total = seen.sum(0)
    kept = np.flatnonzero((total >= LEAST) & (keys > 0))
    kept = np.sort(kept[np.argsort(-total[kept], kind="stable")][:ROWS])
    totals = np.bincount(labels.astype(int), minlength=2)
    learner = Learner(start(keys[kept], seen[:, kept], totals, widths, filters, dim, seed), class_weights(totals), rate)
    rng, word_rows = np.random.default_rng(seed), rows_of(keys[kept], found)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            learner.learn([docs[i] for i in chosen], word_rows, labels[chosen])
    return model_of(keys[kept], learner.params)


def best_threshold(values: np.ndarray, n: np.ndarray, hits: np.ndarray) -> float:
    """Middle of the gap between falling distinct values at which F1 is largest; ``n`` rows have each value, ``hits`` of them class 1."""
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    at = int(np.argmax(f1))
    return float((values[at] + values[at + 1]) / 2) if at + 1 < len(values) else float(values[at])


def calibrate(model: Model, counts: pd.DataFrame, least: int = 40) -> Model:
    """Scale the score so that 0.5 is the best threshold of all; then a threshold for each language of ``least`` rows.

    ``counts``: ``lang, step, n, hits`` of the rows held back, of which a step is 1 / STEPS of an answer.
    """
    def cut(part: pd.DataFrame) -> float:
        by = part.groupby("step")[["n", "hits"]].sum().sort_index(ascending=False)
        return best_threshold(by.index.to_numpy() / STEPS, by["n"].to_numpy(), by["hits"].to_numpy())

    n, hits = counts["n"].sum(), counts["hits"].sum()
    model.scale, model.thresholds = (1.0, -cut(counts) if 0 < hits < n else 0.0), {"": 0.5}
    for lang, part in counts.groupby("lang"):  # rows without a language are in none
        if part["n"].sum() >= least and 5 <= part["hits"].sum() < part["n"].sum():
            model.thresholds[lang] = float(1 / (1 + np.exp(-np.clip(cut(part) + model.scale[1], -60, 60))))
    return model


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", label_col: str = "toxic") -> Model:
    """Model from all labelled rows whose id satisfies ``trainable`` (an expression over the id column).

    Each text is read once and written as the hashes of its words, in an order by chance within its task; counts, rounds and
    calibration read that. Only counts of the words that get a row, and the model, come to the driver.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & trainable).groupBy(F.col(id_col).cast("bigint").alias("__id"))
             .agg(F.max(F.col(label_col).cast("int")).alias("__y")))
    known = materialise(known, "labelled")  # two numbers a row; Spark knows by its size whether texts have to move to them
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).alias("__text"), lang.alias("__lang")).join(known, "__id")

    def numbers():
        def run(texts):
            own = by_text(*numbered(texts))
            return [[d.astype("<i4").tobytes() for d, _ in own], [h.astype("<u4").tobytes() for _, h in own]]
        return run

    held, one = F.pmod(F.xxhash64("__id", F.lit("held")), F.lit(5)) == 0, F.col("__y") == 1
    coded = (append(rows, "__text", "__words binary, __hashes binary", numbers).drop("__text").withColumn("__held", held)
             .sortWithinPartitions(F.xxhash64("__id"), "__id", "__hashes", "__words"))
    coded, n = materialise_counted(coded.drop("__id"), "toxic-words", toxic=F.count_if(one), held=F.count_if("__held"), held_toxic=F.count_if(one & F.col("__held")))
    if not 0 < n["toxic"] < n["rows"]:  # nothing to learn from: the share of toxic rows as a constant
        model = model_of(np.zeros(0, np.uint32), start(np.zeros(0, np.uint32), np.zeros((2, 0)), np.ones(2)))
        model.out, model.out_bias, model.thresholds = model.out * 0, (4.0 if n["toxic"] else -4.0), {"": 0.5}
        return model
    totals = np.array([n["rows"] - n["toxic"], n["toxic"]])
    apart = np.array([n["held"] - n["held_toxic"], n["held_toxic"]])
    split = min(*apart, *(totals - apart)) >= 5
    learned, judged = (coded.where("NOT __held"), coded.where("__held")) if split else (coded, coded)
    totals = totals - apart if split else totals
    keys, seen = vocabulary(learned)
    learned = learned.coalesce(max(1, int(totals.sum()) // TASK_ROWS))
    params = start(keys, seen, totals)
    for _ in range(ROUNDS):
        params = learn_round(learned, keys, params, class_weights(totals))
    model = model_of(keys, params)
    return calibrate(model, answers(judged, model).toPandas())  # a row for each step of an answer and language


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Labels, documents as numbers of words, and the hashes of those words."""
    words, hashed = (batch.column(c).to_pylist() for c in ("__words", "__hashes"))
    flat = np.concatenate([np.frombuffer(h, "<u4") for h in hashed]).reshape(-1, PARTS)
    _, places, number = np.unique(flat[:, 0], return_index=True, return_inverse=True)
    offsets = np.cumsum([0] + [len(h) // (4 * PARTS) for h in hashed])
    docs = [number[first + np.frombuffer(w, "<i4")] for w, first in zip(words, offsets)]
    return batch.column("__y").to_numpy(), docs, flat[places]


def vocabulary(coded: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that get a row, sorted, and in how many documents of each class they are; counted over all rows."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in filter(len, batches):
            found = [np.unique(np.frombuffer(h, "<u4")) for h in batch.column("__hashes").to_pylist()]
            y = np.repeat(batch.column("__y").to_numpy(), [len(f) for f in found])
            keys, at = np.unique(np.concatenate(found), return_inverse=True)
            n, hits = np.bincount(at, minlength=len(keys)), np.bincount(at, y, len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(hits.astype(np.int64))], names=["h", "n", "hits"])
    counted = (coded.select("__y", "__hashes").mapInArrow(run, "h bigint, n bigint, hits bigint").where("h > 0").groupBy("h")
               .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).where(F.col("n") >= LEAST))
    kept = counted.orderBy(F.desc("n"), "h").limit(ROWS).toPandas().sort_values("h")
    return kept["h"].to_numpy().astype(np.uint32), np.stack((kept["n"] - kept["hits"], kept["hits"])).astype(float)


def learn_round(coded: DataFrame, keys: np.ndarray, params: dict[str, np.ndarray], weights: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters after every task went over its rows once, averaged over the tasks in Spark, a block of the table at a time."""
    shared, names = coded.sparkSession.sparkContext.broadcast((keys, params, weights)), sorted(n for n in params if n != "table")

    def run(batches: Iterator[pa.RecordBatch]):
        keys, before, weights = shared.value
        learner = Learner({n: p.copy() for n, p in before.items()}, weights)
        for batch in filter(len, batches):
            y, docs, found = _read(batch)
            word_rows = rows_of(keys, found)
            for at in range(0, len(docs), BATCH):
                learner.learn(docs[at:at + BATCH], word_rows, y[at:at + BATCH])
        if learner.rows:
            change = {n: p - before[n] for n, p in learner.params.items()}
            dense = np.concatenate([change[n].ravel() for n in names])
            blocks = [(-1, np.full(1, learner.rows), dense[None])]
            blocks += [(at, learner.met[at:at + BLOCK], change["table"][at:at + BLOCK]) for at in range(0, len(keys) + 1, BLOCK)]
            for at, n, change in blocks:
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([n.astype("<f8").tobytes()]), pa.array([(change * n[:, None]).astype("<f4").tobytes()])],
                                                 names=["block", "n", "change"])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        n = np.sum([np.frombuffer(b, "<f8") for b in frame["n"]], 0)
        change = np.sum([np.frombuffer(b, "<f4").astype(float) for b in frame["change"]], 0)
        return pd.DataFrame({"block": frame["block"][:1], "change": [(change.reshape(len(n), -1) / np.maximum(n, 1)[:, None]).astype("<f8").tobytes()]})

    got = (coded.select("__y", "__words", "__hashes").mapInArrow(run, "block bigint, n binary, change binary")
           .groupBy("block").applyInPandas(total, "block bigint, change binary").collect())  # one model
    after = {n: p.copy() for n, p in params.items()}
    for r in got:
        change, first = np.frombuffer(r["change"], "<f8"), 0
        if r["block"] >= 0:
            part = after["table"][r["block"]:r["block"] + BLOCK]
            part += change.reshape(part.shape)
            continue
        for n in names:
            after[n] += change[first:first + after[n].size].reshape(after[n].shape)
            first += after[n].size
    shared.unpersist()
    return after


def answers(coded: DataFrame, model: Model) -> DataFrame:
    """``lang, step, n, hits``: how many rows, and toxic ones, get which answer before calibration."""
    shared = coded.sparkSession.sparkContext.broadcast((model, model.projected(), max(model.filters)))

    def run(batches: Iterator[pa.RecordBatch]):
        m, projected, width = shared.value
        for batch in filter(len, batches):
            y, docs, found = _read(batch)
            word_rows = m.rows_of(found)
            pooled = np.vstack([pool(*local(docs[at:at + 64], word_rows), projected, width) for at in range(0, len(docs), 64)])
            z = np.clip(pooled.astype(float) @ m.out + m.out_bias, -60, 60)
            yield pa.RecordBatch.from_arrays([batch.column("__lang"), pa.array(np.rint(z * STEPS).astype(np.int32)), pa.array(y.astype(np.int32))], names=["lang", "step", "y"])
    rows = coded.select("__y", "__lang", "__words", "__hashes").mapInArrow(run, "lang string, step int, y int")
    return rows.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))


def local(docs: list[np.ndarray], word_rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The same documents over the words that occur in them."""
    used, inverse = np.unique(np.concatenate(docs), return_inverse=True)
    return np.split(inverse, np.cumsum([len(d) for d in docs])[:-1]), word_rows[used]


def score(df: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the score of every whole text."""
    projected, width = model.projected(), max(model.filters)
    shared = df.sparkSession.sparkContext.broadcast((projected, width, model))  # at most ROWS times filters

    def make():
        rows, k, m = shared.value

        def run(texts):
            scores = []
            for at in range(0, len(texts), 512):
                docs, found = numbered(texts[at:at + 512])
                scores.append(m.score(pool(docs, m.rows_of(found), rows, k)))
            return [np.concatenate(scores)]
        return run
    return append(df, text_col, f"{out} double", make)


def rejects(model: Model, score_col: str = "score", lang_col: str = "lang") -> Column:
    """Whether a scored row reaches the threshold of its language."""
    pairs = [x for k, v in model.thresholds.items() if k for x in (F.lit(k), F.lit(v))]
    own = F.create_map(*pairs)[F.col(lang_col)] if pairs else F.lit(None).cast("double")
    return F.col(score_col) >= F.coalesce(own, F.lit(model.thresholds[""]))
