"""HyperMinHash near-duplicates: compressed registers, banded, estimated, then confirmed on whole shingle sets.

A shingle's 64-bit hash chooses one of 256 registers by its upper bits; the register keeps the
smallest of the rest, compressed to the number of leading zeros and ten bits behind the first one (16
bits a register). Documents meet when all registers of a band are equal. A band's number of registers follows
from the threshold, so that a pair at the threshold is missed with a probability below ``MISSED``.

Links found are closed to components. All copies of one set are one representative. In a bucket
(equal band) every representative is compared with the smallest one; where that leaves several
components in a bucket, the members outside the smallest one's component are compared with all
members of other components, so no link that could change a component is lost, and a group of near copies costs its size,
not its square. Two members that share several buckets are compared in the first of them only, so that a set moves for
each bucket in which it has a pair of its own, not for all that it shares. A comparison first estimates the Jaccard similarity from the registers, corrected for registers that are
equal by chance, and only drops pairs MARGIN standard errors below the threshold; the rest is confirmed on the full sets.

Null and empty texts have no set and no link; a text of fewer words than a shingle is one shingle. Rows
without id are components of their own (null). Rows of equal id are one document for the components: what links one links all. Until
links are closed, a representative is a node of its own: its id, or, for all but one of the sets of an id that represents several,
a negative number drawn from id and content.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsync.llm.common import append, slices, small_batches, words_of
from tabsync.storage import materialise, materialise_counted

REGISTERS, REGISTER_BITS, MANTISSA = 256, 8, 10
MISSED, MARGIN = 1e-8, 4.5
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    parts = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for p in parts for w in p), np.int64, int(counts.sum()))
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))[codes]
    out, at = [], 0
    with np.errstate(over="ignore"):
        rolled, n = np.zeros(max(0, len(hashed) - size + 1), np.uint64), len(hashed)
        for i in range(size):
            rolled = rolled * _MUL + hashed[i:n - size + 1 + i] if len(rolled) else rolled
        rolled = mix(rolled)
        for n in counts.tolist():
            if n >= size:
                out.append(np.unique(rolled[at:at + n - size + 1]))
            else:
                short = reduce(lambda h, w: h * _MUL + w, hashed[at:at + n], np.uint64(n))
                out.append(mix(np.array([short], np.uint64)) if n else np.zeros(0, np.uint64))
            at += n
    return out


def registers(found: np.ndarray) -> np.ndarray:
    """Registers of a sorted set of hashes; 0 is an empty register."""
    out = np.zeros(REGISTERS, np.uint16)
    number = (found >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
    first = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(found) else np.zeros(0, np.int64)
    rest = found[first] & np.uint64((1 << (64 - REGISTER_BITS)) - 1)
    _, places = np.frexp(rest.astype(np.float64))  # number of bits of the rest; rounding up at most at a power of two
    places = places - ((rest >> np.minimum(places, 63).astype(np.uint64) - np.uint64(1)) == 0) * (places > 0)
    zeros = np.minimum(64 - REGISTER_BITS - places, 62)
    shift = np.maximum(places - 1 - MANTISSA, 0).astype(np.uint64)
    tail = (rest >> shift) & np.uint64((1 << MANTISSA) - 1)
    out[number[first]] = ((zeros + 1) << MANTISSA | tail.astype(np.int64)).astype(np.uint16)
    return out


def band_rows(threshold: float, registers_: int = REGISTERS) -> int:
    """Most registers in a band for which a pair at the threshold is missed with a probability below MISSED."""
    return max(r for r in range(1, 17) if r == 1 or (1 - threshold**r) ** (registers_ // r) < MISSED)


_DONORS = np.random.default_rng(5).integers(0, REGISTERS, (REGISTERS, 48))


def densified(signatures: np.ndarray) -> np.ndarray:
    """Empty registers borrow from others, in an order of their own that is the same for all documents.

    So registers of small sets are equal with the probability of the Jaccard similarity too, and a band never rests on one shingle.
    """
    out = signatures.copy()
    rows, cols = np.nonzero(out == 0)
    some = signatures.any(axis=1)[rows]
    rows, cols = rows[some], cols[some]
    for t in range(_DONORS.shape[1]):
        if not len(rows):
            return out
        got = signatures[rows, _DONORS[cols, t]]
        out[rows, cols] = got
        rows, cols = rows[got == 0], cols[got == 0]
    for row in np.unique(rows):  # very small sets: the next register in use
        used = np.flatnonzero(signatures[row])
        own = cols[rows == row]
        out[row, own] = signatures[row, used[np.searchsorted(used, own) % len(used)]]
    return out


def band_keys(signatures: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Row number and key of every band; ``signatures``: (documents, registers). Documents without shingles have none."""
    bands = REGISTERS // rows
    some = np.flatnonzero(signatures.any(axis=1))
    cut = densified(signatures[some])[:, :bands * rows].reshape(len(some), bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), cut.shape[:2]).copy()
        for i in range(rows):
            keys = mix(keys * _MUL + cut[:, :, i] + np.uint64(1))
    return np.repeat(some, bands), keys.ravel().view(np.int64)


def margin(n: np.ndarray) -> np.ndarray:
    """How far below the threshold an estimate may be: MARGIN standard errors, more for few registers in use."""
    return MARGIN * np.sqrt(0.13 / np.clip(n, 1, REGISTERS))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimate of pairs of signatures: share of equal registers less those equal by chance.

    Two different sets have equal registers by chance if they agree in zeros and mantissa. Of two independent minima that fall
    into the same octave (with about one third probability where sets are of like size) 2 ** -MANTISSA are equal.
    """
    used = ((a > 0) | (b > 0)).sum(1)
    equal = ((a == b) & (a > 0)).sum(1)
    chance = np.minimum(n_a, n_b) / np.maximum(1, np.maximum(n_a, n_b)) / 3 / (1 << MANTISSA)
    share = equal / np.maximum(1, used)
    return (share - chance) / (1 - chance)


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared, len(a) + len(b) - shared


def _sets(cells: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64) for x in cells]


def _signatures(cells: pa.Array) -> np.ndarray:
    joined = b"".join(x.as_py() for x in cells)
    return np.frombuffer(joined, np.uint16).reshape(-1, REGISTERS)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for edges ``a, b``; nodes without edges are not in it.

    Every round passes the smallest label over each edge to the node and to the node's label, then jumps to the label of the label,
    so the rounds grow with the logarithm of the longest path. Each round is written, so lost executors cost one round.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        far = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("far")), "b")
        near = far.groupBy(F.col("a").alias("node")).agg(F.min("far").alias("component"))
        own = near.join(labels.withColumnRenamed("component", "own"), "node")
        told = own.select("node", "component").union(own.select(F.col("own").alias("node"), "component"))
        least = materialise(labels.union(told).groupBy("node").agg(F.min("component").alias("component")), "labels")
        jump = least.join(least.select(F.col("node").alias("component"), F.col("component").alias("next")), "component")
        after = materialise(jump.select("node", F.col("next").alias("component")), "labels")
        if after.exceptAll(labels).isEmpty():
            return labels
        labels = after


def _pairs_confirmed(pairs: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """Those ``a, b`` whose sets have 100 * intersection >= threshold * union. ``docs``: id, sig, items."""
    side = lambda x: docs.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("items").alias(f"items_{x}"))
    wide = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b", "items_a", "items_b")

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 4):
                a, b = _sets(batch.column(4)), _sets(batch.column(5))
                keep = _likely(_signatures(batch.column(2)), _signatures(batch.column(3)), np.array([len(x) for x in a]),
                               np.array([len(x) for x in b]), threshold / 100)
                for i in np.flatnonzero(keep):
                    shared, union = jaccard(a[i], b[i])
                    keep[i] = 100 * shared >= threshold * union
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return wide.mapInArrow(run, "a bigint, b bigint")


def _likely(sig_a, sig_b, n_a, n_b, threshold: float) -> np.ndarray:
    """Pairs that their sizes and the estimate allow."""
    least = np.minimum(n_a, n_b)
    return (least >= threshold * np.maximum(n_a, n_b) - 1e-9) & (estimate(sig_a, sig_b, n_a, n_b) >= threshold - margin(least))


#: Members of a bucket that one task compares with as many others, and about the most bytes of sets that they have.
BLOCK, BLOCK_BYTES = 2048, 8 << 20


def _blocks(members: DataFrame, payload: Column) -> DataFrame:
    """Rows of a bucket dealt into pairs of blocks of bounded size: any two members meet in one pair of blocks. ``payload``: bytes of a row."""
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(payload) / BLOCK_BYTES)).cast("int").alias("blocks")
    sizes = materialise(members.groupBy("key").agg(blocks), "blocks")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    return (members.join(sizes, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "blocks"))


#: Pairs that are looked at together.
PAIRS = 1 << 13


def _pairs_of(groups: np.ndarray, own: np.ndarray, comp: np.ndarray, n: np.ndarray, threshold: float):
    """Row numbers of pairs that may be linked, PAIRS at a time at most: rows that stand together with equal ``groups``, of different
    components, of like size, and of the two blocks that meet there (of one block where it meets itself)."""
    first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    ends = np.repeat(np.append(first[1:], len(groups)), np.diff(np.append(first, len(groups))))
    two = np.repeat(np.maximum.reduceat(own, first) != np.minimum.reduceat(own, first), np.diff(np.append(first, len(groups))))
    partners = ends - np.arange(len(groups)) - 1
    total = np.cumsum(partners)
    at = 0
    while at < len(groups):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + PAIRS * 16, "right")))
        x = np.repeat(np.arange(at, end), partners[at:end])
        y = x + 1 + np.arange(len(x)) - np.repeat(total[at:end] - partners[at:end] - before, partners[at:end])
        keep = (comp[x] != comp[y]) & ((own[x] != own[y]) | ~two[x]) & (np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]) - 1e-9)
        x, y = x[keep], y[keep]
        for part in range(0, len(x), PAIRS):
            yield x[part:part + PAIRS], y[part:part + PAIRS]
        at = end


def _by_bucket(rows: DataFrame, work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on whole groups (key, low, high), many of them at a time; a group is of bounded size, see :func:`_blocks`."""
    keys = ("key", "low", "high")
    many = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number of its own: small rows, much work

    def run(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            groups = _group_numbers(table)
            cut = int(np.searchsorted(groups, groups[-1]))  # the last group may go on in the next batch
            if cut:
                yield work(table.slice(0, cut).combine_chunks())
            rest = table.slice(cut).combine_chunks()
        if rest is not None:
            yield work(rest)
    return rows.repartition(many, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _group_numbers(table: pa.Table) -> np.ndarray:
    columns = [table.column(c).to_numpy() for c in ("key", "low", "high")]
    change = np.zeros(max(0, table.num_rows - 1), bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate([[0], np.cumsum(change)])


def _first_met(keys: np.ndarray, here: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether ``here`` is the first bucket that rows ``x`` and ``y`` share; ``keys``: those of all bands of a row, in order."""
    first = (keys[x] == keys[y]).argmax(axis=1)
    return keys[x, first] == here[x]


def _rest(mixed: DataFrame, reps: DataFrame, items: DataFrame, threshold: int) -> DataFrame:
    """Confirmed links between members of a bucket that are of different components so far (key, id, comp)."""
    share, width = threshold / 100, band_rows(threshold / 100)
    rows = mixed.join(reps.select("id", "n", "sig"), "id")

    def likely(table: pa.Table):
        n, comp, sig = table.column("n").to_numpy(), table.column("comp").to_numpy(), _signatures(table.column("sig"))
        here, keys = table.column("key").to_numpy(), band_keys(sig, width)[1].reshape(len(n), -1)  # members have shingles, so all bands
        for x, y in _pairs_of(_group_numbers(table), table.column("own").to_numpy(), comp, n, share):
            once = _first_met(keys, here, x, y)
            x, y = x[once], y[once]
            keep = _likely(sig[x], sig[y], n[x], n[y], share)
            yield x[keep], y[keep]

    def flagged(table: pa.Table) -> pa.RecordBatch:
        found = np.zeros(table.num_rows, bool)
        for x, y in likely(table):
            found[x] = found[y] = True
        some = table.select(["key", "id"]).filter(pa.array(found))
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in some.columns], names=["key", "id"])

    def confirmed(table: pa.Table) -> pa.RecordBatch:
        sets, ids, comp = _sets(table.column("items")), table.column("id").to_numpy(), table.column("comp").to_numpy()
        links, joined, seen = [], set(), set()  # components that are linked already need no second link
        for x, y in likely(table):
            for i, j in zip(x.tolist(), y.tolist()):
                between = (comp[i], comp[j]) if comp[i] < comp[j] else (comp[j], comp[i])
                pair = (ids[i], ids[j]) if ids[i] < ids[j] else (ids[j], ids[i])
                if between in joined or pair in seen:
                    continue
                seen.add(pair)
                shared, union = jaccard(sets[i], sets[j])
                if 100 * shared >= threshold * union:
                    joined.add(between)
                    links.append(pair)
        return pa.RecordBatch.from_arrays([pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)], names=["a", "b"])
    near = materialise(_by_bucket(_blocks(rows, F.length("sig")), flagged, "key bigint, id bigint").distinct(), "flagged")
    full = mixed.join(near, ["key", "id"], "left_semi").join(items, "id")
    return materialise(_by_bucket(_blocks(full, F.length("items") + F.length("sig")), confirmed, "a bigint, b bigint").distinct(), "links")


def near_duplicates(df: DataFrame, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row of ``df``; ``threshold`` in per cent of the union."""
    small_batches(df.sparkSession)

    def make():
        def run(texts):
            found = shingles(texts, size)
            return [[len(s) for s in found], [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found],
                    [registers(s).tobytes() for s in found]]
        return run
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    given = F.col("id").isNotNull() & F.col("content").isNotNull()
    all_rows, seen = materialise_counted(append(texts, "text", "n bigint, content binary, sig binary", make).drop("text"), "signatures", given=F.count_if(given))
    sets = all_rows.where("id IS NOT NULL AND content IS NOT NULL")
    # Copies: one representative for each set; an id that has several sets links their representatives.
    firsts = materialise(sets.groupBy("content").agg(F.min("id").alias("rep")), "firsts")
    member, told = materialise_counted(sets.select("id", "content").distinct().join(firsts, "content").select("id", "rep"), "members")
    repeated = told["rows"] < seen["given"]  # an id has the same set twice
    several_sets = materialise(firsts.groupBy("rep").agg(F.min("content").alias("least"), F.max("content").alias("last")).where("least < last").drop("last"), "several-sets")
    node = F.when(F.col("content") > F.col("least"), F.lit(-(1 << 62)) - F.shiftrightunsigned(F.xxhash64("rep", "content"), 2)).otherwise(F.col("rep"))
    nodes = firsts.join(several_sets, "rep", "left").select("rep", "content", node.alias("node"))
    alias = materialise(nodes.where("node != rep").select("node", "rep"), "nodes")

    def real(pairs: DataFrame, *columns: str) -> DataFrame:
        """Ids in place of nodes."""
        for c in columns:
            pairs = pairs.join(alias.withColumnRenamed("node", c), c, "left").withColumn(c, F.coalesce("rep", c)).drop("rep")
        return pairs
    first_rows = sets.join(nodes, (sets["content"] == nodes["content"]) & (sets["id"] == nodes["rep"]))
    reps = materialise(first_rows.select(F.col("node").alias("id"), "rep", sets["content"], "n", "sig").dropDuplicates(["rep", "content"]), "reps")
    rows = band_rows(threshold / 100)

    def bands(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                where, keys = band_keys(_signatures(part.column(1)), rows)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(where)), pa.array(keys)], names=["id", "key"])
    banded = materialise(reps.select("id", "sig").mapInArrow(bands, "id bigint, key bigint"), "bands")
    hubs = materialise(banded.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").drop("last"), "hubs")
    met = materialise(banded.join(hubs, "key"), "met")
    star = materialise(met.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "star")
    # Written, so that their sizes are known: texts stay where they are if the ids can be broadcast.
    wanted = materialise(reps.select("id", "rep", "content").join(materialise(met.select("id").distinct(), "met-ids"), "id", "left_semi"), "wanted")
    chosen_ids = materialise(wanted.select(F.col("rep").alias("id")).distinct(), "chosen")

    def make_items():
        def run(texts):
            found = [s.tobytes() for s in shingles(texts, size)]
            return [[xxhash.xxh3_128_digest(s) for s in found], found, [registers(np.frombuffer(s, np.uint64)).tobytes() for s in found], [len(s) // 8 for s in found]]
        return run
    chosen = texts.join(chosen_ids, "id", "left_semi")
    with_items = append(chosen, "text", "content binary, items binary, sig binary, n bigint", make_items).withColumnRenamed("id", "rep")
    found_items = with_items.join(wanted, ["rep", "content"]).select("id", "items", "sig", "n")
    items = materialise(found_items.dropDuplicates(["id"]) if repeated else found_items, "items")
    copies = member.where("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    links = materialise(_pairs_confirmed(star, items, threshold), "links")
    labels = components(links)
    # Buckets that hold several components still.
    with_comp = met.join(labels.select(F.col("node").alias("id"), F.col("component")), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp"))
    several = with_comp.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    mixed = materialise(with_comp.join(materialise(several, "several"), "key", "left_semi"), "mixed")
    more = _rest(mixed, reps, items.select("id", "n", "sig", "items"), threshold)
    found = components(real(links.union(more), "a", "b").select("a", "b").union(copies))
    return (all_rows.join(found.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
