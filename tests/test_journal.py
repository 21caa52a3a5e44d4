"""Change sets, the journal of a load, its counters, and references with several targets."""

import glob
import os
import sys

import pytest
from pyspark.sql import functions as F

from tabsync import plans, storage
from tabsync.operators import load
from tabsync.spec import Ref, TableSpec
from tabsync.storage import new_path

ACC, CON = TableSpec("acc", "id", "k"), TableSpec("con", "id", "k", refs=(Ref("acc", ("acc",), "acc"),))


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_bytes_written_follow_the_batch(spark, tmp_path, monkeypatch):
    target = spark.range(50_000).select("id", F.concat(F.lit("k"), "id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    target.write.parquet(f"{tmp_path}/target")
    target = spark.read.parquet(f"{tmp_path}/target")
    monkeypatch.setattr(storage, "shared_dir", lambda spark: str(tmp_path / "shared"))
    sizes = []
    for n in (10, 1000):
        before = size(tmp_path / "shared")
        batch = spark.range(n).select(F.concat(F.lit("k"), F.col("id") * 100).alias("k"), F.lit("new").alias("v"))
        written = load.upsert(target, batch, "k", "id")
        sizes.append(size(tmp_path / "shared") - before)
        assert written.count() == 50_000 + max(0, n - 500) and written.where("_op IS NOT NULL").count() == n
    whole = size(tmp_path / "target")
    assert sizes[0] < whole / 100 and sizes[1] < whole / 5


def test_versions_read_as_tables_written_whole(spark, frame, rows):
    target = frame("id int, k string, a string", (1, "x", "old"), (2, "y", "old"), (3, "z", "old"), (4, None, "old"))
    one = load.upserted_rows(target, frame("k string, a string", ("x", "one"), ("n", "one")), "k", "id")
    version = load.Version(target, "id").add(storage.materialise(one))
    two = load.upserted_rows(version.read(), frame("k string, a string", ("n", "two"), ("y", "two"), ("m", "two")), "k", "id")
    version = version.add(storage.materialise(two))
    want = [(1, "x", "one"), (2, "y", "two"), (3, "z", "old"), (4, None, "old"), (5, "n", "two"), (6, "m", "two")]
    assert rows(version.read()) == want
    gone = version.add(storage.materialise(load.deleted_rows(version.read(), frame("i int", (5,), (3,), (99,)), "id")))
    assert rows(gone.read()) == [r for r in want if r[0] not in (3, 5)]
    whole = gone.compact()
    assert whole.sets == () and rows(whole.read()) == rows(gone.read())
    back = gone.add(storage.materialise(load.insert(gone.read(), frame("k string, a string", ("z", "new")), "id", ["k"])))
    assert (7, "z", "new") in rows(back.read()) or (5, "z", "new") in rows(back.read())


@pytest.fixture
def source(frame):
    return {"acc": frame("id int, k string, v string, mail string", (1, "a", "1", "a@x.org"), (2, "b", "2", None), (3, "b", "3", "c@x.org")),
            "con": frame("id int, k string, acc int", (1, "c", 1), (2, "d", 2))}


@pytest.fixture
def target(frame):
    return {"acc": frame("id int, k string, v string, mail string", (10, "a", "old", None), (11, "z", "old", None)),
            "con": frame("id int, k string, acc int", (20, "c", 11))}


def test_a_load_that_breaks_can_be_opened_and_undone(spark, source, target, rows):
    bundle = plans.export(source, [ACC, CON], new_path(spark, "test"))

    def breaks(df, spec, attempt):
        return df.withColumn("errors", F.expr("no_such_column")) if spec.name == "con" else df

    with pytest.raises(plans.LoadStopped) as stop:
        plans.load(target, bundle, [ACC, CON], checker=breaks, journal=(journal := new_path(spark, "journal")))
    assert stop.value.result.journal == journal
    again = plans.LoadResult.recover(target, journal, [ACC, CON])
    for result in (stop.value.result, again):
        assert rows(result.env["acc"], "id", "k", "v") == [(10, "a", "1"), (11, "z", "old"), (12, "b", "3")]
        assert rows(result.env["con"]) == rows(target["con"])
        assert {r["table"]: r["status"] for r in result.log.collect()} == {"acc": "success", "con": "failed"}
        back, report = plans.rollback(result.env, result, [ACC, CON])
        assert rows(back["acc"]) == rows(target["acc"]) and [r["status"] for r in report.collect()] == ["OK"]


def test_the_journal_brings_flags_and_held_values_back(spark, frame, rows):
    spec = TableSpec("rule", "id", "k", active_col="on", deferred=("cond", "adv"))
    source = {"rule": frame("id int, k string, on boolean, cond string, adv string", (1, "a", True, "Custom", "p"), (2, "n", False, "Any", None))}
    target = {"rule": frame("id int, k string, on boolean, cond string, adv string", (10, "a", True, "Any", "q"), (11, "z", True, "Any", "q"))}
    result = plans.load(target, plans.export(source, [spec], new_path(spark, "test")), [spec])
    again = plans.LoadResult.recover(target, result.journal, [spec])
    want = [(10, "a", True, "Custom", "p"), (11, "z", True, "Any", "q"), (12, "n", False, "Any", None)]
    assert rows(result.env["rule"]) == want and rows(again.env["rule"]) == want
    assert rows(again.xwalk) == rows(result.xwalk) and rows(again.counters) == rows(result.counters)
    assert rows(plans.rollback(again.env, again, [spec])[0]["rule"]) == rows(target["rule"])


def test_counters_results_and_reads(spark, source, target, rows, monkeypatch):
    bundle = plans.export(source, [ACC, CON], new_path(spark, "test"))
    read, write = [], storage.materialise

    def watched(df, *args, **kw):
        read.extend({f.split(bundle.path)[1].split("/part-")[0] for f in df.inputFiles() if bundle.path in f})
        return write(df, *args, **kw)

    monkeypatch.setattr(storage, "materialise", watched)
    monkeypatch.setattr(sys.modules["tabsync.plans.load"], "materialise", watched)
    result = plans.load(target, bundle, [ACC, CON], mask=True, results=(where := new_path(spark, "results")))
    assert read and all(read.count(folder) <= 2 for folder in set(read))
    n = {(r["table"], r["counter"]): r["n"] for r in result.counters.collect()}
    assert (n["acc", "read"], n["acc", "repeated_keys"], n["acc", "inserted"], n["acc", "updated"], n["acc", "masked"]) == (3, 1, 1, 1, 2)
    assert (n["con", "inserted"], n["con", "updated"], n["con", "references_missed"]) == (1, 1, 0)
    assert rows(result.env["acc"], "k", "mail") == [("a", "a@x.org.invalid"), ("b", "c@x.org.invalid"), ("z", None)]
    out = spark.read.parquet(where)
    assert out.where("outcome = 'success'").count() == 4 and out.where("outcome = 'failure'").count() == 0
    assert rows(spark.createDataFrame([(k, v.count()) for k, v in result.compact("acc").items()], "t string, n bigint")) == [("acc", 3), ("con", 2)]


@pytest.mark.parametrize("order", [("acc", "con"), ("con", "acc")])
def test_every_target_of_a_reference_keeps_its_values(spark, frame, rows, order):
    """Value 7 is a row of con, 3 of acc, 5 of both: the first target counts."""
    specs = [ACC, TableSpec("con", "id", "k", refs=(Ref("up", order, "up"),))]
    source = {"acc": frame("id int, k string", (3, "a3"), (5, "same")),
              "con": frame("id int, k string, up int", (7, "c7", None), (5, "same", 7), (8, "c8", 3), (9, "c9", 5), (10, "c10", 99))}
    empty = {t: df.where("false") for t, df in source.items()}
    result = plans.load(empty, plans.export(source, specs, new_path(spark, "test")), specs)
    con, acc = ({r["id"]: r["k"] for r in result.env[t].collect()} for t in ("con", "acc"))
    up = {r["k"]: r["up"] for r in result.env["con"].collect()}
    both = {"con": con, "acc": acc}
    assert con[up["same"]] == "c7" and acc[up["c8"]] == "a3" and up["c7"] is None and up["c10"] is None
    assert both[order[0]][up["c9"]] == "same"
    missed = result.counters.where("table = 'con' AND counter = 'references_missed'").agg(F.sum("n")).first()[0]
    assert missed == 1  # value 99, which no table has
