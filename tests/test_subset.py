import random

import pytest

from tabsync.operators import subset
from tabsync.spec import Ref, TableSpec

SPECS = [TableSpec("grand", "id", "k"), TableSpec("lookup", "id", "k", refs=(Ref("g", ("grand",)),)),
         TableSpec("root", "id", "k", name_col="n", refs=(Ref("l", ("lookup",)),)),
         TableSpec("child", "id", "k", refs=(Ref("r", ("root",)), Ref("l", ("lookup",))), filter="v > 0"),
         TableSpec("leaf", "id", "k", refs=(Ref("c", ("child",)), Ref("r", ("root",)))), TableSpec("other", "id", "k"),
         TableSpec("helper", "id", "k", resolve_only=True)]


@pytest.fixture
def env(frame):
    return {
        "grand": frame("id int, k string", (1, "g1"), (2, "g2"), (3, "g3")),
        "lookup": frame("id int, k string, g int", (1, "l1", 1), (2, "l2", 2), (3, "l3", 3)),
        "root": frame("id int, k string, n string, l int", (1, "r1", "one", 1), (2, "r2", "two", 2)),
        "child": frame("id int, k string, r int, l int, v int", (1, "c1", 1, 2, 1), (2, "c2", 1, 1, 0), (3, "c3", 2, 3, 1)),
        "leaf": frame("id int, k string, c int, r int", (1, "x1", 1, None), (2, "x2", 3, 2), (3, "x3", None, 1), (4, "x4", 3, 1)),
        "other": frame("id int, k string", (1, "o1")),
        "helper": frame("id int, k string", (1, "h1"), (2, "h2")),
    }


def ids(frames):
    return {t: sorted(r["id"] for r in df.collect()) for t, df in frames.items()}


def test_down_and_up_to_the_grandparents(env):
    got = ids(subset.subset(env, SPECS, "root", ["one"]))
    # Leaf 4 hangs on root 1 and on child 3, which comes along on the way up, with root 2 and lookup 3 behind it.
    assert got == {"root": [1, 2], "child": [1, 3], "leaf": [1, 3, 4], "lookup": [1, 2, 3], "grand": [1, 2, 3], "helper": [1, 2]}


def test_result_is_closed_upward(env):
    cut = subset.subset(env, SPECS, "root", ["one"])
    for spec in SPECS:
        for ref in spec.refs if spec.name in cut else ():
            parents = {r["id"] for r in cut[ref.to[0]].collect()}
            assert {r[ref.col] for r in cut[spec.name].collect()} - {None} <= parents


def test_tables_reached_on_the_way_down_can_be_left_alone(env):
    got = ids(subset.subset(env, SPECS, "root", [1], match_by="id", grow=False))
    assert got == {"root": [1], "child": [1], "leaf": [1, 3, 4], "lookup": [1, 2], "grand": [1, 2], "helper": [1, 2]}


def test_errors(env):
    with pytest.raises(ValueError):
        subset.subset(env, SPECS, "nowhere", ["one"])
    with pytest.raises(ValueError):
        subset.subset(env, SPECS, "root", ["none of these"])


def test_values_may_be_a_frame(env, frame):
    assert ids(subset.subset(env, SPECS, "root", frame("n string", ("two",)), grow=False))["root"] == [2]


def test_tables_on_a_cycle(frame):
    specs = [TableSpec("a", "id", refs=(Ref("b", ("b",)),)), TableSpec("b", "id", refs=(Ref("a", ("a",)),))]
    env = {"a": frame("id int, b int", (1, 1), (2, 3), (3, 2), (4, None)), "b": frame("id int, a int", (1, 2), (2, 1), (3, 3))}
    # Down from a1: b2 refers to it. Up: a1 needs b1, which needs a2, then b3, a3, and b2 again.
    assert ids(subset.subset(env, specs, "a", [1], match_by="id")) == {"a": [1, 2, 3], "b": [1, 2, 3]}


def test_portable_keys_choose_the_best_column(env, frame):
    specs = [s.with_(auto_number_key=s.name == "leaf", name_col="k" if s.name == "leaf" else s.name_col) for s in SPECS]
    src = {**env, "lookup": frame("id int, k string, g int", (1, None, 1), (2, None, 2), (3, "", 3))}
    keys = subset.portable_keys(src, specs, "root", ["one"], grow=False)
    assert {t: c for t, (c, _) in keys.items()} == {"root": "n", "child": "k", "leaf": "k", "lookup": "id", "grand": "k"}
    tgt = {"root": frame("id int, n string", (70, "one"), (71, "two")), "child": frame("id int, k string", (5, "c1"), (6, "zz"))}
    assert ids(subset.restrict(tgt, specs, keys)) == {"root": [70], "child": [5]}


def plain_closure(env, specs, selected):
    """Down, then up, row by row."""
    rows = {t: [r.asDict() for r in df.collect()] for t, df in env.items()}
    down = {t: set(ids) for t, ids in selected.items()}

    def links(spec):
        return [(r.col, p) for r in spec.refs for p in r.to]
    grew = True
    while grew:
        grew = False
        for spec in specs:
            for row in rows[spec.name]:
                if row["id"] not in down.get(spec.name, ()) and any(row[c] is not None and row[c] in down.get(p, ()) for c, p in links(spec)):
                    down.setdefault(spec.name, set()).add(row["id"])
                    grew = True
    up, grew = {t: set(ids) for t, ids in down.items()}, True
    while grew:
        grew = False
        for spec in specs:
            for row in rows[spec.name]:
                for c, p in links(spec) if row["id"] in up.get(spec.name, ()) else ():
                    if row[c] is not None and row[c] not in up.get(p, ()):
                        up.setdefault(p, set()).add(row[c])
                        grew = True
    return ({t: sorted(v) for t, v in down.items()}, {t: sorted(v) for t, v in up.items()})


def test_a_table_on_a_cycle_is_entered_again(frame):
    """Row 2 of a refers to row 1 of b, which is selected only behind row 1 of a."""
    specs = [TableSpec("root", "id"), TableSpec("a", "id", refs=(Ref("r", ("root",)), Ref("b", ("b",)))), TableSpec("b", "id", refs=(Ref("a", ("a",)),))]
    env = {"root": frame("id int", (1,)), "a": frame("id int, r int, b int", (1, 1, None), (2, None, 1), (3, None, 2)),
           "b": frame("id int, a int", (1, 1), (2, 2), (9, 8))}
    roots = {"root": frame("id int", (1,))}
    assert ids(subset.walk_down(env, specs, roots)) == {"root": [1], "a": [1, 2, 3], "b": [1, 2]}


def test_references_of_a_table_to_itself_are_followed(frame, monkeypatch):
    monkeypatch.setattr(subset, "PIECES", 3)
    specs = [TableSpec("t", "id", refs=(Ref("up", ("t",)),))]
    env = {"t": frame("id int, up int", *[(i, i - 1 if i else None) for i in range(8)], (20, 21), (21, 20))}
    assert ids(subset.walk_down(env, specs, {"t": frame("id int", (3,))})) == {"t": [3, 4, 5, 6, 7]}
    assert ids(subset.walk_up(env, specs, {"t": frame("id int", (3,))})) == {"t": [0, 1, 2, 3]}
    assert ids(subset.walk_down(env, specs, {"t": frame("id int", (20,))})) == {"t": [20, 21]}


@pytest.mark.parametrize("seed", range(3))
def test_closure_of_random_tables(frame, seed):
    rnd = random.Random(seed)
    names = ["a", "b", "c"]
    specs = [TableSpec(t, "id", refs=tuple(Ref(f"f{i}", tuple(rnd.sample(names, rnd.choice([1, 1, 2])))) for i in range(2))) for t in names]
    some = lambda: rnd.choice([None, None, *range(8)])
    env = {t: frame("id int, f0 int, f1 int", *[(i, some(), some()) for i in range(8)]) for t in names}
    down = subset.walk_down(env, specs, {"a": frame("id int", (0,), (1,))})
    want = plain_closure(env, specs, {"a": {0, 1}})
    assert ids(down) == want[0] and ids(subset.walk_up(env, specs, down)) == want[1]


def test_rows_without_a_key_go_by_name_or_id(frame):
    specs = [TableSpec("root", "id", "k", name_col="n"), TableSpec("t", "id", "k", name_col="n", refs=(Ref("r", ("root",)),))]
    src = {"root": frame("id int, k string, n string", (1, "r", "one")),
           "t": frame("id int, k string, n string, r int", (1, "k1", "a", 1), (2, None, "b", 1), (3, "", None, 1), (4, "k4", "b", None))}
    tgt = {"root": src["root"], "t": frame("id int, k string, n string, r int", (11, "k1", "x", 1), (12, None, "b", 1), (3, None, "", 1), (13, "k9", "b", 1), (14, None, "z", 1))}
    here, there = subset.subset_portable(src, tgt, specs, "root", ["one"])
    assert ids(here)["t"] == [1, 2, 3] and ids(there)["t"] == [3, 11, 12]


def test_ids_move_alone_on_the_way_down(env, monkeypatch):
    """A row goes to the parents of one reference as its id and that value, not once for each reference with the name of the parent and the value as text."""
    plans, write = [], subset.materialise_counted

    def seen(df, *args, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **kw)
    monkeypatch.setattr(subset, "materialise_counted", seen)
    roots = subset.root_ids(env, SPECS[2], ["one"])
    assert ids(subset.walk_down(env, SPECS, {"root": roots})) == {"root": [1], "child": [1], "leaf": [1, 3, 4]}
    assert not any("Generate explode" in p for p in plans)
