import random
import sys

import pytest
from pyspark.sql import functions as F

from tabsync import storage
from tabsync.operators import graph
from tabsync.sources.catalog import column_inventory
from tabsync.spec import FieldMeta, Ref, TableSpec, load_order, table_tiers


def tiers(df):
    return {r["node"]: (r["tier"], r["in_cycle"], r["below_cycle"]) for r in df.collect()}


def test_two_references_to_one_parent_are_no_cycle(frame):
    edges = frame("child string, parent string", ("b", "a"), ("b", "a"), ("c", "b"), ("c", "a"), ("x", "x"), ("b", "outside"))
    got = tiers(graph.dependency_tiers(edges, frame("node string", ("a",), ("b",), ("c",), ("x",), ("alone",))))
    assert got == {"a": (0, False, False), "b": (1, False, False), "c": (2, False, False), "x": (0, False, False), "alone": (0, False, False)}


def test_a_cycle_shares_the_last_tier(frame):
    edges = frame("child string, parent string", ("b", "a"), ("c", "b"), ("p", "q"), ("q", "p"), ("r", "q"), ("s", "r"), ("leaf", "s"))
    nodes = frame("node string", *[(n,) for n in ("a", "b", "c", "p", "q", "r", "s", "leaf")])
    got = tiers(graph.dependency_tiers(edges, nodes))
    assert {n: got[n] for n in "abc"} == {"a": (0, False, False), "b": (1, False, False), "c": (2, False, False)}
    assert {got[n] for n in "pq"} == {(3, True, False)} and {got[n] for n in ("r", "s", "leaf")} == {(3, True, True)}


def test_only_a_cycle(frame):
    edges = frame("child string, parent string", ("p", "q"), ("q", "p"))
    assert tiers(graph.dependency_tiers(edges, frame("node string", ("p",), ("q",)))) == {"p": (0, True, False), "q": (0, True, False)}


def test_no_edges(frame):
    empty = frame("child string, parent string", ("a", "b")).where("false")
    assert tiers(graph.dependency_tiers(empty, frame("node string", ("a",)))) == {"a": (0, False, False)}


def test_edges_lead_to_lower_tiers_like_the_plan_of_a_run(spark, frame):
    specs = [TableSpec("line", refs=(Ref("o", ("order",)), Ref("o2", ("order",)), Ref("p", ("product",)))),
             TableSpec("order", refs=(Ref("a", ("account",)),)), TableSpec("account", refs=(Ref("parent", ("account",)),)),
             TableSpec("product"), TableSpec("m", refs=(Ref("n", ("n",)),)), TableSpec("n", refs=(Ref("m", ("m",)),))]
    env = {s.name: frame("Id string", ("1",)).selectExpr("Id", *[f"Id AS {r.col}" for r in s.refs]) for s in specs}
    edges, own = graph.fk_edges(column_inventory(spark, env, specs), [s.name for s in specs])
    assert [r["child"] for r in own.collect()] == ["account"]
    got = tiers(graph.dependency_tiers(edges, frame("node string", *[(s.name,) for s in specs])))
    assert {n: v[:2] for n, v in got.items()} == table_tiers(specs)
    assert [s.name for s in load_order(specs)] == ["account", "product", "order", "line", "m", "n"]


def test_system_references_make_no_edge(spark, frame):
    metas = [FieldMeta("t", "OwnerId", "reference", ("User",)), FieldMeta("t", "x", "reference", ("Profile", "p")),
             FieldMeta("t", "y", "reference", ("p", "q")), FieldMeta("t", "RecordTypeId", "reference", ("p",))]
    env = {"t": frame("OwnerId int, x int, y int, RecordTypeId int", (1, 1, 1, 1))}
    edges, own = graph.fk_edges(column_inventory(spark, env, known=metas))
    assert [(r["field"], r["parent"]) for r in edges.collect()] == [("y", "p")] and own.count() == 0


def test_gaps_count_distinct_children(frame, rows):
    edges = frame("child string, parent string", ("a", "p"), ("a", "p"), ("b", "p"), ("b", "q"))
    own = frame("child string, parent string", ("s", "s"), ("p", "p"))
    nodes = frame("node string, key string", ("p", None), ("q", "k"), ("s", ""), ("b", None))
    assert rows(graph.key_gaps(edges, nodes, own), "node", "children") == [("p", 2), ("s", 0)]


def test_choice_of_key(frame):
    assert graph.pick_key(["x", "b__c", "a__c"], ["a__c"]) == "a__c"
    assert graph.pick_key(["x", "b__c"]) == "b__c" and graph.pick_key(["x"]) == "x" and graph.pick_key([]) is None
    df = frame("u string, d string, n string", ("1", "a", "1"), ("2", "a", None), ("3", "b", "3"))
    assert [r["column"] for r in graph.rank_key_candidates(df, ["d", "n", "u"], ["d"]).collect()] == ["u", "d", "n"]


def plain_tiers(edges, nodes):
    """Tiers by peeling on the driver; None for what never gets free."""
    parents = {n: {p for c, p in edges if c == n and p != n and p in nodes} for n in nodes}
    out, level = {}, 0
    while ready := [n for n in nodes if n not in out and parents[n] <= out.keys()]:
        out.update({n: level for n in ready})
        level += 1
    return {n: out.get(n) for n in nodes}


def stuck_both_ways(edges, stuck):
    """Nodes among the stuck ones that are on a cycle or between two."""
    core = set(stuck)
    while gone := {n for n in core if not any(p == n and c in core and c != n for c, p in edges)}:
        core -= gone
    return core


@pytest.mark.parametrize("seed", range(6))
def test_tiers_of_random_graphs(frame, seed):
    rnd = random.Random(seed)
    nodes = list(range(40))
    edges = [(c, rnd.randrange(max(1, c)) if seed % 2 else rnd.randrange(40)) for c in nodes for _ in range(rnd.choice([0, 1, 1, 1, 2]))]
    edges += [(50, 1), (2, 60), (3, 3)] + edges[:5]
    want = plain_tiers(edges, nodes)
    stuck = {n for n, t in want.items() if t is None}
    on = stuck_both_ways([(c, p) for c, p in edges if c in stuck and p in stuck], stuck)
    last = max([t for t in want.values() if t is not None], default=-1) + 1
    got = tiers(graph.dependency_tiers(frame("child int, parent int", *edges), frame("node int", *[(n,) for n in nodes])))
    assert got == {n: (last if n in stuck else want[n], n in stuck, n in stuck and n not in on) for n in nodes}


def test_long_chains_take_rounds_by_the_logarithm(spark, monkeypatch):
    """A chain of 5,000 behind which a tree hangs, and one of 500 behind a cycle."""
    writes, write = [], storage.materialise
    for name in ("tabsync.operators.graph", "tabsync.storage"):
        monkeypatch.setattr(sys.modules[name], "materialise", lambda *a, **k: writes.append(1) or write(*a, **k))
    chain = spark.range(1, 5000).select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent"))
    tree = spark.range(5000, 6000).select(F.col("id").alias("child"), F.when(F.col("id") < 5010, F.col("id") * 0 + 4999).otherwise(F.floor(F.col("id") / 10) + 4500).alias("parent"))
    circle = spark.range(7001, 7500).select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent")).union(spark.sql("SELECT 7000L, 7002L"))
    edges = chain.union(tree).union(circle)
    got = graph.dependency_tiers(edges, spark.range(7500)).collect()
    assert len(writes) < 60
    by = {r["node"]: r for r in got}
    assert [by[n]["tier"] for n in (0, 1, 2500, 4999, 5005, 5010, 5999)] == [0, 1, 2500, 4999, 5000, 5001, 5002]
    last = by[7000]["tier"]
    assert all(by[n]["in_cycle"] and by[n]["tier"] == last for n in range(7000, 7500))
    assert [n for n in range(7000, 7500) if not by[n]["below_cycle"]] == [7000, 7001, 7002]
    writes.clear()
    graph.dependency_tiers(chain, spark.range(5000)).collect()
    assert len(writes) < 30


def test_edges_move_by_child_once(spark, frame, monkeypatch):
    """Where nothing can be broadcast: right tiers, repeated nodes counted once, and edges told apart once, each written once."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        written, write = {}, storage.materialise
        monkeypatch.setattr(graph, "materialise", lambda df, label="frame", **k: written.setdefault(label, write(df, label, **k)))
        edges = [(1, 0), (2, 0), (3, 1), *[(c, c % 4) for c in range(4, 30)] * 2, (7, 1), (35, 1), (2, 36)]
        nodes = list(range(30))
        got = graph.dependency_tiers(frame("child int, parent int", *edges), frame("node int", *[(n,) for n in nodes + nodes[:9]])).collect()
        assert len(got) == 30 and {r["node"]: r["tier"] for r in got} == plain_tiers(edges, nodes)
        assert sorted((r["child"], r["parent"]) for r in written["told-apart"].collect()) == sorted(set(edges))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
