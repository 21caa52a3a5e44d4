"""Dependency graphs of tables and of records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsync.functions import has_key
from tabsync.operators.lookup import broadcastable
from tabsync.storage import materialise, materialise_counted

# References that never count as dependencies.
SYSTEM_TABLES = ("User", "Group", "Organization", "RecordType", "Profile")
SYSTEM_FIELDS = ("OwnerId", "CreatedById", "LastModifiedById", "RecordTypeId", "SetupOwnerId")


def fk_edges(fields: DataFrame, scope: Sequence[str] | None = None,
             first_target_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """(edges between different tables, self references): child, parent, field, relationship.

    ``fields`` is a column inventory; parents out of scope make no edge.
    """
    targets = F.slice("reference_to", 1, 1) if first_target_only else F.col("reference_to")
    refs = (fields.where((F.size("reference_to") > 0) & ~F.col("field").isin(*SYSTEM_FIELDS))
            .select(F.col("table").alias("child"), F.explode(targets).alias("parent"), "field", "relationship")
            .where(~F.col("parent").isin(*SYSTEM_TABLES)))
    own = refs.where(F.col("child") == F.col("parent"))
    others = refs.where(F.col("child") != F.col("parent"))
    if scope is not None:
        others = others.where(F.col("parent").isin(*scope) & F.col("child").isin(*scope))
    return others, own


def dependency_tiers(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tier, in_cycle, below_cycle): a node's tier is one more than the largest of its parents, 0 without parents.

    Nodes on a cycle and behind one share one final tier: ``in_cycle`` marks
    it and ``below_cycle`` tells the nodes that only depend on a cycle from those on one or between two. Nodes
    are the first column of ``nodes``; edges to other nodes, repeated edges and loops are ignored.

    Only nodes that are parents themselves take part in the rounds of :func:`_levels`. The others, usually the bulk,
    get their tier from their parents in one join at the end. All edges move by child once, to be told apart and made distinct, and
    those of the others once by parent; their tiers meet the nodes in one aggregate.
    """
    nodes = nodes.select(F.col(nodes.columns[0]).alias("node"))
    edges = edges.select("child", "parent").where(F.col("child") != F.col("parent"))
    parents = materialise(edges.select(F.col("parent").alias("node")).distinct()
                          .join(nodes, "node", "left_semi"), "parents")
    # Small beside the edges in most graphs; then Spark broadcasts it and the edges stay where they are.
    is_parent = F.col("child") == F.col("node")
    told = _told_apart(edges, parents)
    inner = materialise(told.where("inner").select("child", "parent").join(parents, F.col("parent") == F.col("node"), "left_semi").distinct(), "edges")
    outer = told.where("NOT inner").select("child", "parent")
    placed, seen = materialise_counted(
        parents.join(_levels(inner), "node", "left").select("node", F.when(F.coalesce("stuck", F.lit(False)), F.lit(None).cast("int"))
                                                            .otherwise(F.coalesce("tier", F.lit(0))).alias("tier")),
        "tiers", stuck=F.count_if(F.col("tier").isNull()), last=F.max("tier"))
    placed = placed.withColumn("below_cycle", F.lit(None).cast("boolean"))
    if seen["stuck"]:
        # What is stuck from below as well is on a cycle or between two.
        held = placed.where("tier IS NULL").select("node")
        among = inner.join(held, is_parent, "left_semi").join(held, F.col("parent") == F.col("node"), "left_semi")
        back = _levels(materialise(among.select(F.col("parent").alias("child"), F.col("child").alias("parent")), "edges-back"))
        on = back.where("stuck").select("node", F.lit(True).alias("_on"))
        flags = held.join(on, "node", "left").select("node", F.col("_on").isNull().alias("_below"))
        placed = materialise(placed.join(flags, "node", "left").select("node", "tier", F.col("_below").alias("below_cycle")), "tiers")
    # A node without children is stuck when one of its parents is.
    leaves = outer.join(placed.withColumnRenamed("node", "parent"), "parent").select(
        F.col("child").alias("node"), (F.col("tier") + 1).alias("tier"), F.when(F.col("below_cycle").isNotNull(), F.lit(True)).alias("below_cycle"))
    none = F.lit(None).cast("boolean")
    rows = nodes.select("node", F.lit(None).cast("int").alias("tier"), none.alias("below_cycle"), F.lit(True).alias("given"))
    known = rows.unionByName(placed.unionByName(leaves).withColumn("given", none))
    known = (known.groupBy("node").agg(F.max("tier").alias("tier"), F.max("below_cycle").alias("below_cycle"), F.max("given").alias("given"))
             .where("given IS NOT NULL").drop("given"))
    last = 0
    if seen["stuck"]:
        known = materialise(known, "tiers")
        top = known.where("below_cycle IS NULL").agg(F.max("tier")).first()[0]
        last = 0 if top is None else top + 1
    stuck_node = F.col("below_cycle").isNotNull()
    tier = F.when(stuck_node, F.lit(last)).otherwise(F.coalesce(F.col("tier"), F.lit(0)))
    return known.select(
        "node", tier.cast("int").alias("tier"), stuck_node.alias("in_cycle"),
        F.coalesce("below_cycle", F.lit(False)).alias("below_cycle"))


def _told_apart(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges with ``inner``: whether the child is among ``parents`` (each once). Where that moves them, they are made distinct and written."""
    known = parents.select("node", F.lit(True).alias("inner"))
    told = edges.join(known, F.col("child") == F.col("node"), "left").select("child", "parent", F.coalesce("inner", F.lit(False)).alias("inner"))
    if broadcastable(parents):
        return told
    return materialise(told.groupBy("child", "parent").agg(F.max("inner").alias("inner")), "told-apart")  # in the tasks of the join


def _levels(edges: DataFrame) -> DataFrame:
    """(node, tier, stuck) of all nodes with a parent: the longest way up to a node without parents; ``stuck`` on a cycle and behind one.

    ``edges`` are distinct and written. A node with a single parent lies right behind it, so chains of such nodes are passed by jumps of doubling
    length, in rounds that grow with the logarithm of their length; so trees of any depth and shape are done then. What is left are the
    nodes with several parents, joined by edges as long as the chains between them: these are peeled, a round for each level of them.
    """
    degree = materialise(edges.groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("up")), "degrees")
    chains, seen = materialise_counted(degree.where("n = 1").select("node", "up", F.lit(1).alias("dist"), F.lit(True).alias("open")), "chains")
    rounds, single = 0, seen["rows"]
    moving = single
    while moving and 1 << rounds <= 2 * single:  # a chain has at most so many nodes; who still moves then runs in a circle
        ahead = chains.select(F.col("node").alias("_at"), F.col("up").alias("_up"), F.col("dist").alias("_dist"))
        hit = F.col("_at").isNotNull()
        chains, seen = materialise_counted(
            chains.join(ahead, F.col("up") == F.col("_at"), "left").select(
                "node", F.when(hit, F.col("_up")).otherwise(F.col("up")).alias("up"),
                F.when(hit, F.least(F.col("dist") + F.col("_dist"), F.lit(1 << 30))).otherwise(F.col("dist")).cast("int").alias("dist"), hit.alias("open")),
            "chains", moving=F.count_if("open"))
        moving, rounds = seen["moving"], rounds + 1
    # Edges between nodes that are no links of chains, each as long as the chain that it passes; ``open`` ones come out of a circle.
    ends = chains.select(F.col("node").alias("_at"), F.col("up").alias("_up"), "dist", "open")
    joints = edges.join(degree.where("n > 1").select("node"), F.col("child") == F.col("node"), "left_semi")
    live, seen = materialise_counted(
        joints.join(ends, F.col("parent") == F.col("_at"), "left")
        .groupBy("child", F.coalesce("_up", "parent").alias("parent"))
        .agg(F.max(F.coalesce("dist", F.lit(0)) + 1).alias("length"), F.max(F.coalesce("open", F.lit(False))).alias("open")), "joints")
    left, tiers = seen["rows"], []
    waits = live.select(F.col("child").alias("node")).distinct()
    known = live.where("NOT open").select(F.col("parent").alias("node")).distinct().join(waits, "node", "left_anti").withColumn("tier", F.lit(0))
    best = None
    while left:
        free = known.withColumnRenamed("node", "_free")
        split, seen = materialise_counted(
            live.join(free, (F.col("parent") == F.col("_free")) & ~F.col("open"), "left")
            .select("child", "parent", "length", "open", (F.col("tier") + F.col("length")).alias("tier")),
            "peel", freed=F.count_if(F.col("tier").isNotNull()))
        if not seen["freed"]:
            break
        live = split.where("tier IS NULL").select("child", "parent", "length", "open")
        reached = split.where("tier IS NOT NULL").select(F.col("child").alias("node"), "tier")
        best = (reached if best is None else best.unionByName(reached)).groupBy("node").agg(F.max("tier").alias("tier"))
        waiting = live.select(F.col("child").alias("node"), F.lit(True).alias("waits")).distinct()
        best = materialise(best.join(waiting, "node", "left"), "reached")
        known = best.where("waits IS NULL").select("node", "tier")
        tiers.append(known)
        best, left = best.where("waits").select("node", "tier"), left - seen["freed"]
    none = F.lit(None).cast("int")
    held = live.select(F.col("child").alias("node")).distinct().select("node", none.alias("tier"), F.lit(True).alias("stuck"))
    joined = reduce(DataFrame.unionByName, [t.select("node", "tier", F.lit(False).alias("stuck")) for t in tiers], held if left else held.where("false"))
    joined = materialise(joined, "joined")
    at_joint = chains.join(joined.select(F.col("node").alias("up"), F.col("tier").alias("_tier"), "stuck"), "up", "left")
    stuck = F.col("open") if moving else F.lit(False)
    stuck = stuck | F.coalesce("stuck", F.lit(False))
    return joined.unionByName(at_joint.select("node", F.when(~stuck, F.coalesce("_tier", F.lit(0)) + F.col("dist")).cast("int").alias("tier"), stuck.alias("stuck")))


def key_gaps(edges: DataFrame, nodes: DataFrame, self_edges: DataFrame | None = None) -> DataFrame:
    """(node, children, reason): nodes without a key that others, or they themselves, refer to.

    ``nodes`` has (node, key); ``children`` counts distinct referring nodes.
    """
    keyless = nodes.where(~has_key("key") | F.col("key").isNull()).select("node").distinct()
    inbound = (edges.select("child", "parent").distinct().groupBy("parent")
               .agg(F.count(F.lit(1)).alias("children")).withColumnRenamed("parent", "node"))
    gaps = inbound.join(keyless, "node", "left_semi").select(
        "node", "children", F.lit("referenced but has no key").alias("reason"))
    if self_edges is not None:
        own = (self_edges.select(F.col("child").alias("node")).distinct()
               .join(keyless, "node", "left_semi").join(gaps.select("node"), "node", "left_anti"))
        gaps = gaps.union(own.select("node", F.lit(0).cast("bigint"),
                                     F.lit("refers to itself but has no key")))
    return gaps


def key_quality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per candidate key column: rows, nulls, blanks, distinct usable values and repeats.

    Values are counted where they are read, so a frequent value does not travel row by row.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counted = (df.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value")
               .agg(F.count(F.lit(1)).alias("n")))
    usable = has_key("value")
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("bigint")
    return counted.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("records"), total(F.col("value").isNull()).alias("null_keys"),
        total(F.col("value") == "").alias("blank_keys"),
        F.count_if(usable).alias("distinct_keys"),
        (total(usable) - F.count_if(usable)).alias("duplicate_rows"))


def rank_key_candidates(df: DataFrame, cols: Sequence[str], preferred: Sequence[str] = (),
                        custom_suffix: str = "__c") -> DataFrame:
    """Candidate keys, best first: complete and unique ones, then the caller's order of preference.

    Without measured differences the preferred names come first, then custom columns, then the rest.
    """
    quality = key_quality(df, cols)
    rank = {c: (preferred.index(c) if c in preferred else
                len(preferred) + (0 if c.endswith(custom_suffix) else len(cols)) + i)
            for i, c in enumerate(cols)}
    preference = F.coalesce(*[F.when(F.col("column") == c, F.lit(r)) for c, r in rank.items()])
    bad = F.col("null_keys") + F.col("blank_keys") + F.col("duplicate_rows")
    return (quality.withColumn("defects", bad).withColumn("preference", preference)
            .orderBy("defects", "preference"))


def pick_key(candidates: Sequence[str], preferred: Sequence[str] = (), custom_suffix: str = "__c") -> str | None:
    """Key column by name alone: preferred, else the first custom one, else the first."""
    for wanted in (*preferred, *[c for c in candidates if c.endswith(custom_suffix)], *candidates):
        if wanted in candidates:
            return wanted
    return None
