"""Approximate nearest neighbours: a forest of random-projection trees, one queue over all trees, exact scores of what it finds.

Trees are fitted on a bounded sample (``SAMPLE`` vectors, by hash of the id): each node projects on
the difference of two random vectors and splits at the median. Every row is then sent down every tree.
A query takes leaves in the order of one queue shared by all trees: a leaf's priority is minus the largest
distance to a split that lies between it and the query, 0 for the query's own leaves. It stops once the leaves taken hold a share of
the rows; this share is measured on the sample so that ``RECALL`` of the true neighbours are found.

Leaves are dealt into groups, queries into blocks; a task scores the queries of a block against the leaves that they
take in its group, in double precision, and passes on its best. Of equal vectors only as many of smallest id as could be
returned are indexed, which is exact. Vectors that are null, zero, of other length than most, or hold nulls or non-finite
numbers take no part; rows of equal id and vector count once. An empty table has no queries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsync.storage import materialise

SAMPLE, RECALL, TREES = 20_000, 0.97, 8
#: Rows of the index (each vector once per tree) in a group of leaves, and queries in a block.
GROUP_ROWS, QUERY_BLOCK = 50_000, 20_000


@dataclass
class Tree:
    """Nodes in the order of their making; a child below 0 is leaf ``-child - 1``."""
    directions: np.ndarray
    splits: np.ndarray
    children: np.ndarray  # (nodes, 2)
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.splits) else np.full(len(x), -1, np.int64)
        while (live := np.flatnonzero(at >= 0)).size:
            node = at[live]
            side = np.einsum("nd,nd->n", x[live], self.directions[node]) > self.splits[node]
            at[live] = self.children[node, side.astype(int)]
        return -at - 1

    def priorities(self, x: np.ndarray) -> np.ndarray:
        """Priority of each leaf for each row of ``x``."""
        out = np.zeros((len(x), self.leaves))
        if not len(self.splits):
            return out
        margins = x @ self.directions.T - self.splits
        reached = np.zeros((len(x), len(self.splits)))
        for node in range(len(self.splits)):  # parents come before children
            far = np.minimum(reached[:, node], -np.abs(margins[:, node]))
            right = margins[:, node] > 0
            for side, child in enumerate(self.children[node]):
                p = np.where(right == bool(side), reached[:, node], far)
                if child < 0:
                    out[:, -child - 1] = p
                else:
                    reached[:, child] = p
        return out


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """Split until a node has at most ``leaf`` rows of the sample, or cannot be split."""
    directions, splits, children, leaves = [], [], [], 0
    work = [(np.arange(len(sample)), None)]
    while work:
        rows, parent = work.pop(0)
        split = None
        for _ in range(5 if len(rows) > leaf else 0):
            a, b = rng.choice(rows, 2, replace=False)
            direction = sample[a] - sample[b]
            norm = np.linalg.norm(direction)
            if norm == 0:
                continue
            direction = direction / norm
            values = sample[rows] @ direction
            cut = float(np.median(values))
            right = values > cut
            if right.any() and not right.all():
                split = (direction, cut, right)
                break
        if split is None:
            number, leaves = -leaves - 1, leaves + 1
        else:
            number = len(splits)
            directions.append(split[0])
            splits.append(split[1])
            children.append([0, 0])
            work += [(rows[~split[2]], (number, 0)), (rows[split[2]], (number, 1))]
        if parent is not None:
            children[parent[0]][parent[1]] = number
    return Tree(np.array(directions).reshape(-1, sample.shape[1]), np.array(splits), np.array(children, int).reshape(-1, 2), leaves)


@dataclass
class Forest:
    trees: list[Tree]
    share: float

    @property
    def first(self) -> np.ndarray:
        """Number of the first leaf of each tree."""
        return np.cumsum([0] + [t.leaves for t in self.trees[:-1]])

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): leaf numbers over all trees."""
        return np.stack([t.leaf_of(x) for t in self.trees], 1) + self.first

    def taken(self, x: np.ndarray, counts: np.ndarray, share: float | None = None) -> np.ndarray:
        """(rows, leaves): what each query takes from the queue until the leaves hold ``share`` of all rows of all trees."""
        priority = np.hstack([t.priorities(x) for t in self.trees])
        order = np.argsort(-priority, axis=1, kind="stable")
        before = np.cumsum(counts[order], axis=1) - counts[order]
        out = np.zeros(priority.shape, bool)
        np.put_along_axis(out, order, before < (self.share if share is None else share) * counts.sum(), axis=1)
        return out


def fit(sample: np.ndarray, rows: int, k: int, trees: int = TREES, recall: float = RECALL, seed: int = 11) -> Forest:
    """Forest whose leaves hold about ``4 * sqrt(rows)`` of all rows, and the least share that reaches the recall on the sample."""
    rng = np.random.default_rng(seed)
    leaf = max(8, int(4 * np.sqrt(rows) * len(sample) / max(1, rows)))
    forest = Forest([grow(sample, leaf, rng) for _ in range(trees)], 1.0)
    if len(sample) <= 4 * k:
        return forest
    leaves = forest.leaves_of(sample)
    counts = np.bincount(leaves.ravel(), minlength=sum(t.leaves for t in forest.trees))
    asked = rng.choice(len(sample), min(200, len(sample)), replace=False)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-scores, k, axis=1)[:, :k]
    for share in (0.005, 0.01, 0.02, 0.04, 0.07, *np.arange(0.1, 1, 0.05)):
        taken = forest.taken(sample[asked], counts, share)
        hit = np.zeros(best.shape, bool)
        for t in range(trees):
            hit |= np.take_along_axis(taken, leaves[best, t], 1)
        if hit.mean() >= recall:
            forest.share = float(share)
            break
    return forest


def clean(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (doubles) of the rows that take part, each once."""
    v = F.col("vector")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    return rows.distinct()


def _merge(best: np.ndarray, who: np.ndarray, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best of each row after adding candidates (row, id, score); an id counts once, ties go to the smaller id."""
    n, k = best.shape
    own = np.flatnonzero(np.isfinite(best))
    rows, ids, scores = (np.concatenate(x) for x in ((own // k, rows), (who.ravel()[own], ids), (best.ravel()[own], scores)))
    order = np.lexsort((ids, rows))
    order = order[np.append(True, (np.diff(rows[order]) != 0) | (np.diff(ids[order]) != 0))[:len(order)]]
    order = order[np.lexsort((ids[order], -scores[order], rows[order]))]
    rows, ids, scores = rows[order], ids[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    best, who = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)
    best[rows[keep], place[keep]], who[rows[keep], place[keep]] = scores[keep], ids[keep]
    return best, who


def score_group(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best k of each query (right: query, vector, taken) among the leaves of a group (left: leaf, id, vector)."""
    if not len(left) or not len(right):
        return pd.DataFrame({"query": [], "vec": [], "score": []}).astype({"query": "int64", "vec": "int64"})
    queries, ids = np.stack(right["vector"].to_numpy()), right["query"].to_numpy()
    best, who = np.full((len(queries), k), -np.inf), np.zeros((len(queries), k), np.int64)
    taken = right["taken"].to_numpy()
    by_leaf = pd.DataFrame({"leaf": np.concatenate(taken), "at": np.repeat(np.arange(len(right)), [len(t) for t in taken])})
    asked = {leaf: g.to_numpy() for leaf, g in by_leaf.groupby("leaf")["at"]}
    for leaf, rows in left.groupby("leaf"):
        at = asked.get(leaf)
        if at is None:
            continue
        vectors, own = np.stack(rows["vector"].to_numpy()), rows["id"].to_numpy()
        for part in range(0, len(at), 512):
            q = at[part:part + 512]
            for a in range(0, len(own), 4096):
                cand = vectors[a:a + 4096]
                # Block products choose; what they choose is summed anew pair by pair, so equal vectors have equal scores.
                r, c = np.nonzero(queries[q] @ cand.T >= best[q, -1][:, None] - 1e-9)
                other = ids[q][r] != own[a + c]
                r, c = r[other], c[other]
                if len(r):
                    exact = np.einsum("nd,nd->n", queries[q][r], cand[c])
                    best[q], who[q] = _merge(best[q], who[q], r, own[a + c], exact)
    rows, cols = np.nonzero(np.isfinite(best))
    return pd.DataFrame({"query": ids[rows], "vec": who[rows, cols], "score": best[rows, cols]})


def nearest(df: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE,
            trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """``query, rank, vec, score``: of each row that satisfies ``is_query`` (over ``id``) the k of largest inner product that the search finds.

    A query id with several vectors asks with the first of them by hash.
    """
    rows = materialise(clean(df, id_col, vector_col).withColumn("dim", F.size("vector")), "vectors")
    spark = df.sparkSession
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    schema = "query bigint, rank int, vec bigint, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.col("dim") == dims["dim"]).drop("dim")
    first = Window.partitionBy("vector").orderBy("id")
    indexed = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).drop("n")
    chosen = indexed.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    vectors = chosen.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dims["dim"])
    forest = fit(vectors, dims["count"], k, trees, recall)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
                leaves = forest.leaves_of(x)
                at = np.repeat(np.arange(len(x)), trees)
                yield pa.RecordBatch.from_arrays([pa.array(leaves.ravel()), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))],
                                                 names=["leaf", "id", "vector"])
    index = materialise(indexed.select("id", "vector").mapInArrow(place, "leaf bigint, id bigint, vector array<double>"), "index")
    counts = np.zeros(sum(t.leaves for t in forest.trees))
    for r in index.groupBy("leaf").count().collect():  # a row for each leaf, of which there are about sqrt(rows) / 4 a tree
        counts[r["leaf"]] = r["count"]
    groups = max(24, int(-(-counts.sum() // GROUP_ROWS)))
    asking = rows.where(is_query)
    blocks = max(1, -(-asking.count() // QUERY_BLOCK))

    def ask(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                taken = forest.taken(np.stack(part.column(1).to_numpy(zero_copy_only=False)), counts)
                who, leaves = np.nonzero(taken)
                by_group = leaves % groups
                order = np.lexsort((leaves, by_group, who))
                who, leaves, by_group = who[order], leaves[order], by_group[order]
                starts = np.flatnonzero(np.append(True, (np.diff(who) != 0) | (np.diff(by_group) != 0)))
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(leaves)), pa.int32()), pa.array(leaves))
                yield pa.RecordBatch.from_arrays([pa.array(by_group[starts]), part.column(0).take(pa.array(who[starts])),
                                                  part.column(1).take(pa.array(who[starts])), lists], names=["grp", "query", "vector", "taken"])
    once = asking.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("vector")))).where("n = 1")
    asked = (once.select(F.col("id").alias("query"), "vector").mapInArrow(ask, "grp bigint, query bigint, vector array<double>, taken array<bigint>")
             .withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks))))
    held = index.withColumn("grp", F.col("leaf") % groups).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "block", F.col("block").cast("bigint"))

    def score(left, right):
        return score_group(left, right, k)
    found = held.groupBy("grp", "block").cogroup(asked.groupBy("grp", "block")).applyInPandas(score, "query bigint, vec bigint, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    return (found.groupBy("query", "vec").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query", "rank", "vec", "score"))
