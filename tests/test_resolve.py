from tabsync.operators import resolve
from tabsync.spec import Ref, TableSpec

PARENT = TableSpec("p", "id", "k")
CHILD = TableSpec("c", "id", "k", refs=(Ref("p__c", ("p",)),))


def test_hit_miss_and_null(frame, rows):
    env = {"p": frame("id string, k string", ("1", "A"), ("2", ""), ("3", None))}
    child = frame("id string, k string, p__c string", ("x", "X", "1"), ("y", "Y", "2"), ("z", "Z", None))
    out = resolve.resolve_references(child, CHILD, resolve.id_maps(env, [PARENT]))
    assert out.columns == ["id", "k", "p__c", "p__r__key", "_source_id"]
    assert rows(out, "k", "p__c", "p__r__key", "_source_id") == [("X", None, "A", "x"), ("Y", "2", None, "y"), ("Z", None, None, "z")]
    assert rows(resolve.unresolved_references(out, CHILD)) == [("p__c", "2", 1)]


def test_relationship_names():
    assert Ref("a__c", ("p",)).relationship == "a__r"
    assert Ref("AccountId", ("p",)).relationship == "Account"
    assert Ref("AccountId", ("p",), "Acc").key_col == "Acc__key"


def test_filter_of_the_parent_limits_its_map(frame):
    env = {"p": frame("id string, k string", ("1", "A"), ("2", "B"))}
    spec = PARENT.with_(filter="k = 'A'")
    assert resolve.id_map(env, spec).count() == 1 and resolve.id_map(env, spec, filtered=False).count() == 2


def test_several_parent_tables_in_order(frame, rows):
    env = {"p": frame("id string, k string", ("1", "P1")), "q": frame("id string, k string", ("1", "Q1"), ("2", "Q2"))}
    spec = TableSpec("c", "id", refs=(Ref("ref", ("p", "q"), "r"),))
    child = frame("id string, ref string", ("a", "1"), ("b", "2"), ("c", "3"))
    out = resolve.resolve_references(child, spec, resolve.id_maps(env, [PARENT, PARENT.with_(name="q")]))
    assert rows(out, "id", "ref", "r__key") == [("a", None, "P1"), ("b", None, "Q2"), ("c", "3", None)]


def test_every_self_reference_gets_a_second_pass(frame, rows):
    spec = TableSpec("t", "id", "k", refs=(Ref("boss__c", ("t",)), Ref("peer__c", ("t",))))
    df = frame("id string, k string, boss__c string, peer__c string", ("1", "A", None, "2"), ("2", "B", "1", None), ("3", None, "1", "1"))
    parts = resolve.self_ref_pass2(df, spec, resolve.id_map({"t": df}, spec))
    assert {c: rows(p) for c, p in parts.items()} == {"boss__c": [("B", "A")], "peer__c": [("A", "B")]}
    main = resolve.resolve_references(df, spec, {})
    assert "boss__c" not in main.columns and "boss__r__key" not in main.columns
    assert resolve.self_ref_pass2(df, spec.with_(self_refs="skip"), df) == {}


def test_joint_lookup_gives_what_the_chain_gives(spark, frame, rows):
    names = ("p", "q", "r", "s")
    env = {n: frame("id int, k string", *[(i, f"{n}{i}") for i in range(5)]) for n in names}
    specs = [PARENT.with_(name=n) for n in names]
    spec = TableSpec("c", "id", refs=tuple(Ref(f"f{n}", (n,), n) for n in names))
    # Repeated and null row ids are rows like all others.
    child = frame("id int, fp int, fq int, fr int, fs int", *[(None if i < 2 else i // 2, i % 5, i % 7, None, i) for i in range(20)])
    maps = resolve.id_maps(env, specs)
    chain = rows(resolve.resolve_references(child, spec, maps))
    assert len(chain) == 20
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows(resolve.resolve_references(child, spec, maps)) == chain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_column_order(frame):
    assert resolve.order_columns(frame("b int, k int, a int", (1, 2, 3)), "k").columns == ["k", "a", "b"]
