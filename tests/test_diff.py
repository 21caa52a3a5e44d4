import pytest
from pyspark.sql import functions as F

from tabsync.operators import diff
from tabsync.spec import FieldMeta, Ref, TableSpec

SPEC = TableSpec("t", "id", "k", order_cols=("id",), name_col="n")
SCHEMA = "id string, k string, n string, v string"


def statuses(df):
    return {r["key"]: r["status"] for r in df.collect()}


def test_null_equals_empty_and_blank_keys_vanish(frame):
    src = frame(SCHEMA, ("1", "a", "A", None), ("2", "b", "B", "x"), ("3", "", "C", "x"), ("4", None, "D", "x"), ("5", " ", "E", "x"))
    tgt = frame(SCHEMA, ("9", "a", "A", ""), ("8", "b", "B", "y"), ("7", "z", "Z", "x"))
    found = diff.diff_by_key(src, tgt, SPEC)
    assert statuses(found) == {"a": "identical", "b": "modified", "z": "deleted", " ": "new"}
    line = diff.diff_summary(found, src, tgt, SPEC).first()
    assert (line["source"], line["target"], line["blank_keys"], line["duplicate_keys"]) == (3, 3, 2, 0)


def test_last_row_of_a_key_counts(frame):
    src = frame(SCHEMA, ("1", "a", "A", "old"), ("2", "a", "A", "new"))
    tgt = frame(SCHEMA, ("9", "a", "A", "new"))
    for order in (src, src.orderBy(F.col("id").desc())):
        found = diff.diff_by_key(order, tgt, SPEC)
        assert [(r["status"], r["source_id"], r["target_id"], r["name"]) for r in found.collect()] == [("identical", "2", "9", "A")]
    assert diff.diff_summary(found, src, tgt, SPEC).first()["duplicate_keys"] == 1


def test_types_are_compared_as_types(frame):
    src = frame("id string, k string, a double, s struct<x:int,y:string>", ("1", "a", 1.0, (1, "p")), ("2", "b", None, (1, "p")))
    tgt = frame("id string, k string, a double, s struct<x:int,y:string>", ("1", "a", 1.0, (1, "q")), ("2", "b", 0.0, (1, "p")))
    joined = diff.join_snapshots(src, tgt, TableSpec("t", "id", "k"))
    changes = {(r["key"], r["field"]): (r["source_value"], r["target_value"]) for r in diff.diff_changes(joined, "t").collect()}
    assert changes == {("a", "s"): ('{"x":1,"y":"p"}', '{"x":1,"y":"q"}'), ("b", "a"): (None, "0.0")}


def test_sides_of_different_type(frame):
    src, tgt = frame("id int, k int, v int", (1, 1, 5), (2, 2, 6)), frame("id string, k string, v string", ("1", "1", "5"), ("2", "2", "7"))
    assert statuses(diff.diff_by_key(src, tgt, TableSpec("t", "id", "k"))) == {"1": "identical", "2": "modified"}


def test_compare_columns(frame):
    src = frame("id string, k string, fk string, OwnerId string, skip string, v string, only string", ("1",) * 7)
    spec = TableSpec("t", "id", "k", refs=(Ref("fk", ("p",)),), compare_ignore=("skip",))
    assert diff.compare_columns(src, src.drop("only"), spec) == ["k", "v"]
    assert diff.compare_columns(src, src, spec.with_(auto_number_key=True)) == ["v", "only"]


def test_mirror(frame):
    a = frame(SCHEMA, ("1", "a", "A", "1"), ("2", "b", "B", "1"))
    b = frame(SCHEMA, ("1", "b", "B", "2"), ("3", "c", "C", "1"))
    there, back = statuses(diff.diff_by_key(a, b, SPEC)), statuses(diff.diff_by_key(b, a, SPEC))
    swap = {"new": "deleted", "deleted": "new"}
    assert {k: swap.get(v, v) for k, v in there.items()} == back
    assert set(statuses(diff.diff_by_key(a, a, SPEC)).values()) == {"identical"}


def test_fingerprint_pairs_rows_and_reports_the_surplus(frame, rows):
    src = frame("id int, k string, a string, b string", (1, "n1", "x", None), (2, "n2", "x", ""), (3, "n3", None, "x"), (4, "n4", "x", None))
    tgt = frame("id int, k string, a string, b string", (11, "m1", "x", None), (12, "m2", "y", "z"))
    spec = TableSpec("t", "id", "k", auto_number_key=True)
    counts = diff.fingerprint_summary(diff.fingerprint_counts(src, tgt, ["a", "b"])).first().asDict()
    assert counts == {"source": 4, "target": 2, "identical": 1, "new": 3, "deleted": 1}
    found = diff.diff_by_fingerprint(src, tgt, spec)
    by_status = {s: found.where(F.col("status") == s).count() for s in ("identical", "new", "deleted", "modified")}
    assert by_status == {"identical": 1, "new": 3, "deleted": 1, "modified": 0}
    norm = lambda df: df.select(F.coalesce("a", F.lit("")).alias("a"), F.coalesce("b", F.lit("")).alias("b"))
    more = diff.surplus(src, tgt, ["a", "b"])
    for status, left, right in (("new", src, tgt), ("deleted", tgt, src)):
        plain = norm(left).exceptAll(norm(right)).groupBy("a", "b").count()
        assert rows(more.where(F.col("status") == status), "a", "b", "copies") == rows(plain)


def test_delta_of_a_numbered_table_finds_rows_by_id(frame, rows):
    spec = TableSpec("t", "id", "k", auto_number_key=True)
    src = frame("id int, k string, a string", (1, "0001", "x"), (2, "0002", "y"), (3, "0003", "y"))
    tgt = frame("id int, k string, a string", (7, "0001", "y"))
    delta = diff.extract_delta(src, diff.diff_by_fingerprint(src, tgt, spec), "id")
    assert delta.count() == 2 and rows(delta.where("a = 'x'"), "id") == [(1,)]


def test_applied_delta_leaves_nothing_new_or_modified(frame):
    a = frame(SCHEMA, ("1", "a", "A", "1"), ("2", "b", "B", "1"))
    b = frame(SCHEMA, ("1", "b", "B", "2"), ("3", "c", "C", "1"))
    delta = diff.extract_delta(a, diff.diff_by_key(a, b, SPEC), "id")
    after = b.join(delta, "k", "left_anti").unionByName(delta)
    assert set(statuses(diff.diff_by_key(a, after, SPEC)).values()) == {"identical", "deleted"}


def test_diff_all_skips_what_cannot_be_compared(frame):
    df = frame(SCHEMA, ("1", "a", "A", "1"))
    specs = [SPEC, TableSpec("keyless", "id"), SPEC.with_(name="gone"), SPEC.with_(name="helper", resolve_only=True)]
    out = diff.diff_all({"t": df, "keyless": df, "gone": df, "helper": df}, {"t": df, "keyless": df, "helper": df}, specs)
    assert out.tables == ("t",)
    with pytest.raises(ValueError):
        diff.diff_all({"keyless": df}, {"keyless": df}, specs)


def test_total_line(frame):
    df = frame(SCHEMA, ("1", "a", "A", "1"))
    specs = [SPEC, SPEC.with_(name="u")]
    out = diff.with_total(diff.diff_all({"t": df, "u": df}, {"t": df, "u": df}, specs).summary)
    assert {r["table"]: r["identical"] for r in out.collect()} == {"t": 1, "u": 1, "TOTAL": 2}


def test_digests_tell_the_same_as_values(frame, rows):
    src = frame(SCHEMA, ("1", "a", "A", None), ("2", "b", "B", "x"), ("3", "c", "C", "x"), ("4", "c", "C", "y"), ("5", "", "D", "y"))
    tgt = frame(SCHEMA, ("9", "a", "A", ""), ("8", "b", "B", "y"), ("7", "c", "C", "y"), ("6", "z", "Z", "x"))
    by_value, by_digest = (diff.diff_by_key(src, tgt, SPEC, digest=d) for d in (False, True))
    assert rows(by_value) == rows(by_digest) and statuses(by_value)["c"] == "identical"
    assert [r["field"] for r in diff.changes_of(by_digest, src, tgt, SPEC).collect()] == ["v"]


def test_digests_need_equal_types(frame):
    wide = frame("id int, k string", (1, "a")).selectExpr("id", "k", *[f"{i} AS c{i}" for i in range(10)])
    assert "sha2" not in diff.diff_by_key(wide, wide, TableSpec("t", "id", "k"))._jdf.queryExecution().optimizedPlan().toString()
    out = diff.diff_by_key(wide, wide, TableSpec("t", "id", "k"), digest=True)
    assert "sha2" in out._jdf.queryExecution().optimizedPlan().toString() and out.first()["status"] == "identical"
    other = wide.withColumn("c3", F.lit("3"))  # another type: back to values
    assert "sha2" not in diff.diff_by_key(wide, other, TableSpec("t", "id", "k"), digest=True)._jdf.queryExecution().optimizedPlan().toString()


def test_fields_policy_reaches_the_diff(frame):
    src = frame("id string, k string, v string, calc string", ("1", "a", "x", "p"))
    tgt = frame("id string, k string, v string, calc string", ("1", "a", "x", "q"))
    spec = TableSpec("t", "id", "k")
    metas = {"t": [FieldMeta("t", c, calculated=c == "calc") for c in src.columns]}
    assert diff.diff_all({"t": src}, {"t": tgt}, [spec], metas).summary.first()["identical"] == 1
    assert diff.diff_all({"t": src}, {"t": tgt}, [spec]).summary.first()["modified"] == 1


def test_counts_without_rows_tell_the_same(frame, rows):
    src = frame(SCHEMA, ("1", "a", "A", None), ("2", "b", "B", "x"), ("3", "b", "B", "z"), ("4", "", "C", "y"), ("5", None, "D", "y"), ("6", "n", "E", "y"))
    tgt = frame(SCHEMA, ("9", "a", "A", ""), ("8", "b", "B", "y"), ("7", "c", "C", "y"), ("6", "c", "Z", "x"), ("5", None, "D", "y"))
    old = diff.diff_summary(diff.diff_by_key(src, tgt, SPEC), src, tgt, SPEC)
    found, line = diff.counted_diff(src, tgt, SPEC)
    for new in (diff.diff_counts(src, tgt, SPEC), line):
        assert rows(new, *old.columns) == rows(old)
    assert rows(found) == rows(diff.diff_by_key(src, tgt, SPEC))
    assert line.first()["duplicate_keys"] == 2 and line.first()["blank_keys"] == 3
    numbered = SPEC.with_(auto_number_key=True)
    found = diff.diff_by_fingerprint(src, tgt, numbered)
    for new in (diff.diff_counts(src, tgt, numbered), diff.counted_diff(src, tgt, numbered)[1]):
        assert rows(new, *old.columns) == rows(diff.diff_summary(found, src, tgt, numbered), *old.columns)
    empty = src.where("false")
    assert rows(diff.diff_counts(empty, empty, SPEC), "new", "identical", "duplicate_keys", "blank_keys") == [(0, 0, 0, 0)]


def test_a_summary_reads_each_side_once(frame, tmp_path):
    paths = []
    for name in ("s", "t"):
        frame(SCHEMA, ("1", "a", "A", name)).write.parquet(f"{tmp_path}/{name}")
        paths.append(f"{tmp_path}/{name}")
    src, tgt = (frame("a int").sparkSession.read.parquet(p) for p in paths)
    for spec in (SPEC, SPEC.with_(auto_number_key=True)):
        plan = diff.diff_counts(src, tgt, spec)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 2 and "Window" not in plan


def test_totals_move_rows_only_where_sides_differ(frame, rows, monkeypatch):
    src = frame("a string, n int, v double", *[(None if i % 7 == 0 else f"t{i % 90}", i % 40, float(i % 3)) for i in range(600)], ("", 0, 0.0), ("x", 1, float("nan")))
    tgt = src.select(F.coalesce("a", F.lit("")).alias("a"), F.col("n").cast("bigint").alias("n"), F.when(F.col("v") == 0, F.lit(-0.0)).otherwise(F.col("v")).alias("v"))
    moved = []
    plain = diff.fingerprint_counts
    monkeypatch.setattr(diff, "fingerprint_counts", lambda s, t, cols: moved.append(s.count()) or plain(s, t, cols))
    same = diff.fingerprint_totals(src, tgt, ["a", "n", "v"])
    assert rows(same) == [(602, 602, 602, 0, 0)] and same.dtypes == diff.fingerprint_summary(plain(src, tgt, ["a", "n", "v"])).dtypes and not moved
    later = tgt.where("n <> 5").union(tgt.where("n = 6").limit(2)).union(frame("a string, n bigint, v double", ("x", 1, 5.0), ("x", 1, None)))
    assert rows(diff.fingerprint_totals(src, later, ["a", "n", "v"])) == rows(diff.fingerprint_summary(plain(src, later, ["a", "n", "v"])))
    assert 0 < moved[0] < 602
    none = src.where("false")
    assert rows(diff.fingerprint_totals(none, none, ["a"])) == [(0, 0, 0, 0, 0)] and rows(diff.fingerprint_totals(src, none, ["a"])) == [(602, 0, 0, 602, 0)]
    swapped = src.select("n", F.when(F.col("n") == 1, "t2").when(F.col("n") == 2, "t1").otherwise("t0").alias("a"))
    other = src.select("n", F.when(F.col("n") == 1, "t1").when(F.col("n") == 2, "t2").otherwise("t0").alias("a"))
    assert rows(diff.fingerprint_totals(swapped, other, ["a", "n"])) == rows(diff.fingerprint_summary(plain(swapped, other, ["a", "n"])))
