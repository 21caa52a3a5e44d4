from pyspark.sql import functions as F

from tabsync.operators import clean
from tabsync.spec import FieldMeta, Ref, TableSpec


def test_keep_last_per_trimmed_key(frame, rows):
    df = frame("k string, n int", ("a", 1), (" a ", 2), ("A", 3), ("", 4), (None, 5), (" \t", 6), ("b", 7), ("a", 0))
    out = clean.dedupe_keep_last(df, "k", ["n"])
    assert rows(out, "n") == [(2,), (3,), (4,), (5,), (6,), (7,)]
    assert rows(clean.dedupe_keep_last(out, "k", ["n"])) == rows(out)
    assert clean.duplicates_removed(df, "k").first()[0] == 2
    assert clean.dedupe_keep_last(df.withColumnRenamed("k", "Id"), "Id", ["n"]).count() == 8


def test_split_drops_the_key_of_inserts(frame):
    named, unnamed = clean.split_by_key(frame("k string, n int", ("a", 1), (" ", 2), (None, 3)), "k")
    assert named.count() == 1 and unnamed.columns == ["n"] and unnamed.count() == 2


def test_retryable_errors(frame, rows):
    df = frame("error string", ("x UNABLE_TO_LOCK_ROW y",), ("unable_to_lock_row",), (None,), ("Too many retries of batch save",))
    assert [r[0] for r in clean.classify_rejects(df).select("retryable").collect()] == [True, False, False, True]


def test_union_of_different_columns(frame, rows):
    out = clean.union_results([frame("a int, b int", (1, 2)), frame("b int, c int", (3, 4))])
    assert rows(out, "a", "b", "c") == [(1, 2, None), (None, 3, 4)]


def test_more_than_half_must_be_addresses(frame):
    df = frame("half string, most string, EMAIL string, text string", ("a@x.org", "a@x.org", "none", "x"), ("n", " b@x.org ", None, "x"), (" ", "n", None, "y"))
    chosen = {r["column"]: r["selected"] for r in clean.email_columns(df).collect()}
    assert chosen == {"half": False, "most": True, "EMAIL": True, "text": False}
    masked, counts = clean.mask_emails(df)
    assert [r["most"] for r in masked.collect()] == ["a@x.org.invalid", "b@x.org.invalid", "n"]
    assert {r["column"]: r["masked"] for r in counts.collect()} == {"most": 2, "EMAIL": 0}
    again, counts = clean.mask_emails(masked)
    assert again.collect() == masked.collect() and counts.agg(F.sum("masked")).first()[0] == 0


def test_only_declared_text_columns_are_searched(frame):
    df = frame("a string, b string, c string", ("a@x.org", "a@x.org", "a@x.org"))
    metas = [FieldMeta("t", "a", "picklist"), FieldMeta("t", "b", "email")]
    assert [r["column"] for r in clean.email_columns(df, metas).collect()] == ["b"]


def test_deferred_values_come_back(frame, rows):
    df = frame("k string, c string, a string", ("1", "Custom", "x AND y"), ("2", "Any", "z"), ("", "Custom", "q"), ("3", "Custom", None))
    held, deferred = clean.defer_values(df, "t", "k", "c", "a")
    assert rows(held) == [("", "Custom", "q"), ("1", "All", None), ("2", "Any", "z"), ("3", "All", None)]
    moved = held.withColumn("k", F.when(F.col("k") == "1", "T1").otherwise(F.col("k")))
    xwalk = frame("source_key string, target_key string", ("1", "T1"))
    back = clean.restore_deferred(moved, deferred, "k", ["c", "a"], xwalk)
    assert rows(back) == [("", "Custom", "q"), ("2", "Any", "z"), ("3", "Custom", None), ("T1", "Custom", "x AND y")]


def test_columns_the_target_refuses(frame):
    df = frame("Id string, k string, OwnerId string, CurrencyIsoCode string, ro string, gone string, fk1 string, fk2 string, fk3 string, "
               "r1__key string, r3__key string", ("1", "a", "u", "EUR", "x", "x", "p", "q", "r", " ", "K"))
    spec = TableSpec("t", "Id", "k", refs=(Ref("fk1", ("p",), "r1"), Ref("fk2", ("p",), "r2"), Ref("fk3", ("p",), "r3")))
    fk = {"type": "reference", "reference_to": ("p",)}
    metas = [FieldMeta("t", "k", createable=False, updateable=False), FieldMeta("t", "OwnerId"), FieldMeta("t", "CurrencyIsoCode", createable=False, updateable=False),
             FieldMeta("t", "ro", createable=False, updateable=False), *[FieldMeta("t", c, **fk) for c in ("fk1", "fk2", "fk3")]]
    out, gone = clean.strip_columns(df, metas, spec, resolved={"fk2"})
    assert out.columns == ["Id", "k", "CurrencyIsoCode", "fk2", "r3__key"]
    assert gone == ["OwnerId", "ro", "gone", "fk1", "fk3", "r1__key"]


def test_fixups(frame, rows):
    df = frame("a string, b boolean", ("x\r\n\ny", True))
    assert rows(clean.fixups(df, {"b": False}, ["a"], {"a": 2})) == [("x ", False)]


def test_checks(frame):
    df = frame("id int, k string, s string, fk string, r__key string", (1, "a", "long text", None, None), (2, " a", " ", "x", ""), (3, None, "ok", "x", "P"), (4, "c", "ok", None, None))
    spec = TableSpec("t", "id", "k", refs=(Ref("fk", ("p",), "r"),))
    metas = [FieldMeta("t", "s", length=5, nullable=False), FieldMeta("t", "absent", nullable=False)]
    out = clean.check_rows(df, metas[:1], spec, frame("k string", ("c",)))
    assert {r["id"]: r["errors"] for r in out.collect()} == {
        1: ["STRING_TOO_LONG:s", "DUPLICATE_VALUE:k"], 2: ["REQUIRED_FIELD_MISSING:s", "UNRESOLVED_REFERENCE:fk", "DUPLICATE_VALUE:k"],
        3: [], 4: ["KEY_EXISTS:k"]}
    ok, bad = clean.split_checked(out)
    assert ok.count() == 1 and bad.count() == 3
    assert clean.check_rows(df, metas, spec.with_(key=None, refs=())).where("array_contains(errors, 'REQUIRED_FIELD_MISSING:absent')").count() == 4


def test_routing_through_the_crosswalk(frame, rows):
    df = frame("fk string, n int", ("s1", 1), ("t1", 2), ("s2", 3), (None, 4))
    xwalk = frame("table string, source_id string, target_id string", ("p", "s1", "t1"), ("p", "s2", "t2"))
    first, rest = clean.route_by_membership(df, "fk", frame("id string", ("t1",), ("t1",)), xwalk)
    assert rows(first, "n") == [(1,), (2,)] and rows(rest, "n") == [(3,), (4,)]
