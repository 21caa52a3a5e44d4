import sys

import pytest
from pyspark.sql import functions as F

from tabsync import plans
from tabsync.operators import clean, crosswalk, load, log
from tabsync.spec import FieldMeta, Ref, TableSpec
from tabsync.storage import new_path, shared_dir


@pytest.fixture
def target(frame):
    return frame("id int, k string, a string, b int", (1, "x", "old", 1), (2, "y", "old", 2), (3, None, "old", 3))


def test_upsert_keeps_what_the_batch_does_not_have(frame, rows, target):
    batch = frame("_source_id string, k string, a string", ("s1", "x", "new"), ("s2", "z", "new"), ("s3", " ", "new"))
    written = load.upsert(target, batch, "k", "id", ["_source_id"])
    assert rows(load.current(written)) == [(1, "x", "new", 1), (2, "y", "old", 2), (3, None, "old", 3), (4, "z", "new", None), (5, None, "new", None)]
    trace = load.loaded_rows(written, 7, "t", "id", "k")
    assert rows(trace, "op", "source_id", "target_id") == [("insert", "s2", "4"), ("insert", "s3", "5"), ("update", "s1", "1")]
    assert trace.where("op = 'update'").first()["prior"]["a"] == "old"


def test_text_ids_continue(frame, rows):
    target = frame("id string, a string", ("new000000000000004", "x"), ("001", "y"))
    out = load.current(load.insert(target, frame("n int, a string", (1, "p"), (2, "q")), "id", ["n"]))
    assert rows(out, "id") == [("new000000000000005",), ("new000000000000006",)]
    assert load.fresh_ids(frame("id long", (5,)).where("false"), frame("n int", (1,)), "id", ["n"]).first()["id"] == 1


def test_delete_keeps_the_removed_rows(frame, rows, target):
    kept, gone = load.delete_ids(target, frame("i int", (1,), (9,)), "id")
    assert rows(kept, "id") == [(2,), (3,)] and rows(gone, "id") == [(1,)]


def test_only_what_was_switched_off_comes_back_on(frame, rows):
    df = frame("id int, on boolean", (1, True), (2, False), (3, None))
    off, ids = load.deactivate(df, "on", "id")
    assert rows(off) == [(1, False), (2, False), (3, None)]
    assert rows(load.reactivate(off, ids, "on", "id")) == [(1, True), (2, False), (3, None)]
    assert load.deactivate(df, "no_such_flag", "id")[1] is None


def test_retry_returns_every_remaining_reject(frame, rows):
    rejects = frame("n int, error string, sf__Id string", (1, "UNABLE_TO_LOCK_ROW", ""), (2, "UNABLE_TO_LOCK_ROW", ""), (3, "BAD", ""), (4, "UNABLE_TO_LOCK_ROW", ""))

    def submit(df, attempt):
        assert df.columns == ["n"]  # bookkeeping columns are gone
        return df.where(F.col("n") == attempt), df.where(F.col("n") != attempt).withColumn(
            "error", F.when(F.col("n") == 4, "NEW_PERMANENT").otherwise("UNABLE_TO_LOCK_ROW"))

    ok, bad, tally = load.retry_rejects(rejects, submit, attempts=2)
    assert rows(ok) == [(1,), (2,)] and rows(bad, "n", "error") == [(3, "BAD"), (4, "NEW_PERMANENT")]
    assert tally == {"retried": 3, "recovered": 2, "failed": 2}
    ok, bad, tally = load.retry_rejects(rejects, submit, attempts=1)
    assert rows(bad, "n") == [(2,), (3,), (4,)] and tally["recovered"] == 1
    assert load.retry_rejects(rejects.where("n = 3"), submit)[0] is None


def test_status_of_a_step(frame):
    df = frame("order int, table string, key_field string, accepted boolean, aborted boolean", (1, "a", "k", True, False), (1, "a", "k", False, False), (2, "b", "k", True, True), (3, "c", None, True, False))
    lines = {r["table"]: r for r in log.load_log(df).collect()}
    assert {t: r["status"] for t, r in lines.items()} == {"a": "partial", "b": "failed", "c": "success"}
    assert [r["table"] for r in log.rollback_plan(log.load_log(df)).collect()] == ["c", "b", "a"]
    total = log.load_summary(log.load_log(df)).where("table = 'TOTAL'").first()
    assert (total["submitted"], total["succeeded"], total["failed"]) == (4, 3, 1)


def test_undo_takes_the_first_step_of_a_row(frame, rows, target):
    once = load.current(w1 := load.upsert(target, frame("k string, a string", ("x", "one"), ("n", "one")), "k", "id"))
    w2 = load.update(once, frame("k string, b int", ("x", 90), ("n", 91)), "k")
    loaded = load.loaded_rows(w1, 1, "t", "id", "k").unionByName(load.loaded_rows(w2, 2, "t", "id", "k"))
    back, report = log.undo_table(load.current(w2), loaded, TableSpec("t", "id", "k"))
    assert rows(back) == rows(target)
    assert report.first().asDict() == {"table": "t", "logged": 2, "deleted": 1, "restored": 1, "status": "OK"}


def test_undo_reports_what_is_missing(frame, target):
    written = load.upsert(target, frame("k string, a string", ("x", "one"), ("n", "one")), "k", "id")
    loaded = load.loaded_rows(written, 1, "t", "id", "k")
    spec = TableSpec("t", "id", "k")
    assert log.undo_table(load.current(written).where("k = 'x'"), loaded, spec)[1].first()["status"] == "PARTIAL"
    assert log.undo_table(load.current(written).where("false"), loaded, spec)[1].first()["status"] == "SKIP"


def test_counters_fill_while_writing(frame):
    df, seen = log.counted(frame("a int", (1,), (2,)), "c", big=F.count_if(F.col("a") > 1))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2, "big": 1}


def test_raw_ids_wait_for_blank_relationships(frame, rows):
    a, b = "a" * 15, "b" * 18
    df = frame("n int, fk string, r__key string", (1, a, None), (2, b, " "), (3, a, "KEY"), (4, "not an id", None), (5, None, None))
    spec = TableSpec("t", "n", refs=(Ref("fk", ("p",), "r"),))
    xwalk = frame(crosswalk.XWALK_SCHEMA, ("p", a, "target"), ("other", b, "wrong"))
    assert rows(crosswalk.resolve_raw_refs(df, spec, xwalk), "n", "fk") == [(1, "target"), (2, None), (3, a), (4, "not an id"), (5, None)]
    assert crosswalk.resolved_columns(df, spec, xwalk) == {"fk"}
    assert crosswalk.resolved_columns(df.where("n > 1"), spec, xwalk) == set()


def test_composite_match_with_nulls(frame, rows):
    src = frame("id int, a string, b string", (1, "x", None), (2, "x", "y"), (3, None, None))
    tgt = frame("id int, a string, b string", (10, "x", None), (11, "x", None), (12, "z", "y"))
    assert rows(crosswalk.match_by_composite(src, tgt, ["a", "b"], "id", "id"), "source_id", "target_id") == [("1", "11"), ("2", None), ("3", None)]


# Whole loads

SPECS = [
    TableSpec("account", "id", "k", refs=(Ref("parent", ("account",), "parent"),), name_col="k"),
    TableSpec("contact", "id", "email", refs=(Ref("account_id", ("account",), "account"),)),
    TableSpec("quote", "id", refs=(Ref("account_id", ("account",), "account"),)),
    TableSpec("line", "id", refs=(Ref("quote_id", ("quote",), "quote"),)),
]


@pytest.fixture
def source(frame):
    return {
        "account": frame("id string, k string, parent string, v string", ("A1", "acme", None, "1"), ("A2", "sub", "A1", "2"), ("A3", None, "A1", "3")),
        "contact": frame("id string, email string, account_id string", ("C1", "a@x.org", "A1"), ("C2", "b@x.org", "A2"), ("C3", " a@x.org ", "A2")),
        "quote": frame("id string, account_id string, v string", ("Q1", "A1", "x"), ("Q2", "A2", "bad"), ("Q3", "A2", "z")),
        "line": frame("id string, quote_id string, n int", ("L1", "Q1", 1), ("L2", "Q3", 2), ("L3", "Q3", 3)),
    }


@pytest.fixture
def empty(source):
    return {t: df.where("false") for t, df in source.items()}


def export(spark, source, specs=SPECS, **kw):
    return plans.export(source, specs, new_path(spark, "test"), **kw)


def test_links_without_keys_follow_the_crosswalk(spark, source, empty, rows):
    bundle = export(spark, source)
    assert [(e[4], e[7]) for e, _ in bundle.entries] == [("account", False), ("account", True), ("contact", False), ("quote", False), ("line", False)]
    result = plans.load(empty, plans.Bundle.open(spark, bundle.path), SPECS)
    env = result.env
    joined = env["line"].join(env["quote"].withColumnRenamed("id", "q"), F.col("quote_id") == F.col("q"))
    assert rows(joined, "n", "v") == [(1, "x"), (2, "z"), (3, "z")]
    accounts = env["account"].alias("c").join(env["account"].alias("p"), F.expr("c.parent = p.id"))
    assert rows(accounts.select("c.k", F.col("p.k").alias("pk"))) == [("sub", "acme")]
    assert env["account"].count() == 3
    # The duplicate contact goes, the last one stays; its account is found by key.
    assert rows(env["contact"].join(env["account"].withColumnRenamed("id", "a"), F.col("account_id") == F.col("a")), "email", "k") == [(" a@x.org ", "sub"), ("b@x.org", "sub")]
    back, report = plans.rollback(env, result, SPECS)
    assert all(df.count() == 0 for df in back.values()) and {r["status"] for r in report.collect()} == {"OK"}
    assert [r["table"] for r in plans.rollback(env, result, SPECS, dry_run=True)[1].collect()] == ["line", "quote", "contact", "account"]
    diff = plans.compare(source, env, [SPECS[0]], only="account").summary.first()
    assert (diff["identical"], diff["new"], diff["deleted"]) == (2, 0, 0)


def reject_bad_quotes(df, spec, attempt):
    error = F.when(F.col("v") == "bad", F.array(F.lit("FIELD_INTEGRITY"))) if spec.name == "quote" else F.lit(None)
    late = F.when((F.col("v") == "z") & F.lit(attempt == 0), F.array(F.lit("UNABLE_TO_LOCK_ROW"))) if spec.name == "quote" else F.lit(None)
    return df.withColumn("errors", F.coalesce(error, late, F.col("errors")))


def test_a_rejected_row_does_not_shift_the_crosswalk(spark, source, empty, rows):
    result = plans.load(empty, export(spark, source), SPECS, on_error="continue", checker=reject_bad_quotes)
    env = result.env
    # Q2 is refused for good; Q3 is recovered by the retry, and its lines still find it.
    assert rows(env["quote"], "v") == [("x",), ("z",)]
    joined = env["line"].join(env["quote"].withColumnRenamed("id", "q"), F.col("quote_id") == F.col("q"), "left")
    assert rows(joined, "n", "v") == [(1, "x"), (2, "z"), (3, "z")]
    line = result.log.where("table = 'quote'").first()
    assert (line["submitted"], line["succeeded"], line["failed"], line["status"]) == (3, 2, 1, "partial")
    assert rows(result.rejected["quote"], "v", "error") == [("bad", "FIELD_INTEGRITY")]


def test_stop_after_a_failure(spark, source, empty):
    result = plans.load(empty, export(spark, source), SPECS, checker=reject_bad_quotes)
    assert [r["table"] for r in result.log.orderBy("order").collect()] == ["account", "account", "contact", "quote"]
    assert result.env["line"].count() == 0 and result.env["quote"].count() == 2


def test_keys_numbered_by_the_target(spark, frame, rows):
    specs = [TableSpec("rule", "id", "num", refs=(Ref("next", ("rule",), "next"),), auto_number_key=True, name_col="n"),
             TableSpec("cond", "id", "k", refs=(Ref("rule_id", ("rule",), "rule"),))]
    source = {"rule": frame("id int, num string, n string, next int", (1, "R-1", "one", None), (2, "R-2", "two", 1)),
              "cond": frame("id int, k string, rule_id int", (1, "c1", 1), (2, "c2", 2))}
    target = {"rule": frame("id int, num string, n string, next int", (50, "A-50", "zero", None)), "cond": source["cond"].where("false")}
    result = plans.load(target, plans.export(source, specs, new_path(spark, "test")), specs)
    names = result.env["rule"].select(F.col("id").alias("r"), "n", "next", "num")
    assert rows(result.env["cond"].join(names, F.col("rule_id") == F.col("r")), "k", "n") == [("c1", "one"), ("c2", "two")]
    one = names.where("n = 'one'").first()
    assert names.where("n = 'two'").first()["next"] == one["r"] and one["num"] == f"A-{one['r']}"
    assert rows(result.key_xwalk, "source_key", "target_key") == [("R-1", "A-51"), ("R-2", "A-52")] and result.env["rule"].count() == 3


def test_flags_deferred_values_and_matched_tables(spark, frame, rows):
    specs = [TableSpec("book", "id", match_on_name=True, name_col="name"),
             TableSpec("rule", "id", "k", active_col="on", deferred=("cond", "adv")),
             TableSpec("price", "id", refs=(Ref("book_id", ("book",), "book"),), load_first=("book_id", "std"))]
    source = {"book": frame("id int, name string, std boolean", (1, "Standard", True), (2, "Retail", False), (3, "Unknown", False)),
              "rule": frame("id int, k string, on boolean, cond string, adv string", (1, "r1", True, "Custom", "1 AND 2"), (2, "r2", False, "Any", None)),
              "price": frame("id int, book_id int, v int", (1, 2, 10), (2, 1, 20), (3, 3, 30))}
    target = {"book": frame("id int, name string, std boolean", (10, "Standard", True), (20, "Retail", False)),
              "rule": frame("id int, k string, on boolean, cond string, adv string", (5, "mine", True, "All", None), (6, "off", False, "All", None)),
              "price": source["price"].where("false")}
    bundle = plans.export(source, specs, new_path(spark, "test"))
    assert "deactivate on" in [e[8] for e, _ in bundle.entries if e[4] == "rule"]
    env = plans.load(target, bundle, specs).env
    assert rows(env["rule"], "k", "on", "cond", "adv") == [("mine", True, "All", None), ("off", False, "All", None), ("r1", True, "Custom", "1 AND 2"), ("r2", False, "Any", None)]
    assert env["book"].count() == 2
    assert rows(env["price"], "id", "book_id", "v") == [(1, 10, 20), (2, 20, 10), (3, None, 30)]  # standard prices come first


def test_masked_text_bundle_into_typed_tables(spark, frame, rows):
    spec = TableSpec("c", "id", "k")
    source = {"c": frame("id int, k string, email string, n int, on boolean, d double", (1, "a", "a@x.org", 5, True, 1.5), (2, 'q"uo,te', None, None, False, None))}
    bundle = plans.export(source, [spec], new_path(spark, "test"), fmt="csv")
    env = plans.load({"c": source["c"].where("false")}, bundle, [spec], mask=True).env
    assert rows(env["c"], "k", "email", "n", "on", "d") == [("a", "a@x.org.invalid", 5, True, 1.5), ('q"uo,te', None, None, False, None)]


def test_fields_of_the_target_decide(spark, frame, rows):
    spec = TableSpec("c", "id", "k")
    source = {"c": frame("id int, k string, a string, b string", (1, "x", "long value", "1"), (2, "y", "ok", "2"))}
    metas = {"c": [FieldMeta("c", "k"), FieldMeta("c", "a", length=4), FieldMeta("c", "b", createable=False, updateable=False)]}
    result = plans.load({"c": source["c"].where("false")}, plans.export(source, [spec], new_path(spark, "test")), [spec], on_error="continue", fields=metas)
    assert rows(result.env["c"], "k", "a", "b") == [("y", "ok", None)] and result.stripped["c"] == ["b"]
    assert result.rejected["c"].first()["error"] == "STRING_TOO_LONG:a"


def test_subset_export_and_delta(spark, source, empty, rows):
    bundle = export(spark, source, root="account", values=["sub"])
    # The account that "sub" refers to comes along: references of a table to itself are followed.
    assert {e[4]: n for e, n in bundle.entries if not e[7]} == {"account": 2, "contact": 2, "quote": 2, "line": 2}
    specs = SPECS[:2]
    target = {t: source[t] for t in ("account", "contact")}
    target["account"] = source["account"].withColumn("v", F.when(F.col("id") == "A2", "changed").otherwise(F.col("v")))
    delta = plans.export_delta(source, plans.compare(source, target, specs), specs, new_path(spark, "test"))
    assert {e[4]: (e[0], n) for e, n in delta.entries} == {"account": ("delta", 1)}


def test_rollback_of_a_saved_load_brings_flags_back(spark, frame, rows):
    spec = TableSpec("rule", "id", "k", active_col="on")
    source = {"rule": frame("id int, k string, on boolean, v string", (1, "a", True, "new"), (2, "b", False, "new"), (3, "c", False, "new"))}
    target = {"rule": frame("id int, k string, on boolean, v string", (10, "a", True, "old"), (11, "b", True, "old"), (12, "z", True, "old"), (13, "y", None, "old"))}
    result = plans.load(target, plans.export(source, [spec], new_path(spark, "test")), [spec])
    # The flag that comes with a row counts; rows that the load does not touch are switched on again.
    assert rows(result.env["rule"], "k", "on", "v") == [("a", True, "new"), ("b", False, "new"), ("c", False, "new"), ("y", None, "old"), ("z", True, "old")]
    again = plans.LoadResult.open(spark, result.save(new_path(spark, "load")))
    back, report = plans.rollback(result.env, again, [spec])
    assert rows(back["rule"]) == rows(target["rule"]) and report.first()["status"] == "OK"


def test_repeated_numbered_keys_are_refused(spark, frame, rows):
    spec = TableSpec("rule", "id", "num", auto_number_key=True)
    source = {"rule": frame("id int, num string, n string", (1, "a", "one"), (2, "a", "two"), (3, "b", "new"))}
    target = {"rule": frame("id int, num string, n string", (10, "a", "zero"))}
    result = plans.load(target, plans.export(source, [spec], new_path(spark, "test")), [spec], on_error="continue")
    assert rows(result.env["rule"]) == [(10, "a", "two"), (11, "A-11", "new")]
    assert rows(result.rejected["rule"], "n", "error") == [("one", "DUPLICATE_VALUE:num")]
    line = result.log.first()
    assert (line["submitted"], line["succeeded"], line["failed"]) == (3, 2, 1)


def test_an_update_never_adds_rows(frame, rows, target):
    batch = frame("_source_id string, k string, a string", ("s1", "x", "one"), ("s2", "x", "two"), ("s3", None, "none"))
    assert rows(load.current(load.update(target, batch, "k")), "id", "a") == [(1, "two"), (2, "old"), (3, "old")]


def test_refused_rows_leave_no_deferred_values(spark, frame, rows):
    spec = TableSpec("rule", "id", "k", deferred=("cond", "adv"))
    source = {"rule": frame("id int, k string, cond string, adv string", (1, "r1", "Custom", "p"), (2, "r2", "Custom", "q"))}
    target = {"rule": frame("id int, k string, cond string, adv string", (5, "r1", "Any", "kept"), (6, "r2", "Any", "kept"))}

    def refuse(df, spec, attempt):
        return df.withColumn("errors", F.when(F.col("k") == "r1", F.array(F.lit("NO"))).otherwise(F.col("errors")))
    result = plans.load(target, plans.export(source, [spec], new_path(spark, "test")), [spec], on_error="continue", checker=refuse)
    assert rows(result.env["rule"]) == [(5, "r1", "Any", "kept"), (6, "r2", "Custom", "q")]


def test_unreadable_values_are_refused_not_nulled(spark, frame, rows):
    spec = TableSpec("c", "id", "k")
    source = {"c": frame("id int, k string, n string", (1, "a", "12x"), (2, "b", "7"), (3, "c", " "))}
    target = {"c": frame("id int, k string, n int", (1, "a", 5), (2, "b", 6))}
    late = lambda df, spec, attempt: df.withColumn("errors", F.concat("errors", F.when(
        F.lit(attempt == 0), F.array(F.lit("UNABLE_TO_LOCK_ROW"))).otherwise(F.array().cast("array<string>"))))
    for checker in (None, late):  # also when the row comes again
        bundle = plans.export(source, [spec], new_path(spark, "test"), fmt="csv")
        result = plans.load(target, bundle, [spec], on_error="continue", checker=checker)
        assert rows(result.env["c"]) == [(1, "a", 5), (2, "b", 7), (3, "c", None)]
        assert "INVALID_VALUE:n" in result.rejected["c"].first()["error"] and result.log.first()["failed"] == 1


class Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, configured, master):
        self.conf, self.sparkContext = self, self
        self.configured, self.master, self.applicationId = configured, master, "app"

    def get(self, name, default):
        return self.configured if name == "spark.checkpoint.dir" and self.configured else default


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(Session("hdfs://shared/checkpoints/", "spark://host:7077")) == "hdfs://shared/checkpoints"
    with pytest.raises(ValueError):
        shared_dir(Session(None, "spark://host:7077"))
    assert shared_dir(spark) == shared_dir(spark)


def test_rows_are_judged_where_they_lie(spark, source, empty, rows, monkeypatch):
    """Tables without a key, whose parents are small, are written as judged only when a row is refused."""
    plan = sys.modules["tabsync.plans.load"]
    written, plain = [], plan.materialise_counted
    monkeypatch.setattr(plan, "materialise_counted", lambda df, label="frame", **kw: written.append(label) or plain(df, label, **kw))
    env = plans.load(empty, export(spark, source), SPECS).env
    assert not {"judged-quote", "judged-line"} & set(written) and "judged-contact" in written
    assert rows(env["quote"], "v") == [("bad",), ("x",), ("z",)] and env["line"].count() == 3
    texts = {**source, "line": source["line"].withColumn("n", F.when(F.col("n") == 2, "two").otherwise(F.col("n").cast("string")))}
    result = plans.load(empty, export(spark, texts), SPECS, on_error="continue")
    assert written.count("judged-line") == 1 and rows(result.env["line"], "n") == [(1,), (3,)]
    assert rows(result.rejected["line"], "error") == [("INVALID_VALUE:n",)]


def test_keys_are_looked_for_twice_only_where_they_can_repeat(spark, frame, rows, monkeypatch):
    spec, asked, plain = TableSpec("c", "id", "k"), [], clean.check_rows
    monkeypatch.setattr(clean, "check_rows", lambda df, fields, spec, *a: asked.append(spec.key) or plain(df, fields, spec, *a))
    source = {"c": frame("id int, k string", (1, "1"), (2, "01"), (3, "1"))}
    for kind, keys in (("string", [None]), ("int", ["k"])):
        asked.clear()
        target = {"c": frame(f"id int, k {kind}").where("false")}
        result = plans.load(target, plans.export(source, [spec], new_path(spark, "test")), [spec], on_error="continue")
        assert asked == keys
        if kind == "string":
            assert rows(result.env["c"], "k") == [("01",), ("1",)]
        else:  # two texts become one number
            assert result.env["c"].count() == 0 and {r["error"] for r in result.rejected["c"].collect()} == {"DUPLICATE_VALUE:k"}
