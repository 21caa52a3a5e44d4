import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import queries
from tabsync import plans
from tabsync.operators import lookup
from tabsync.sinks import build_manifest, write_csv
from tabsync.sinks.bundle import manifest_entry, write_table
from tabsync.sources import (column_inventory, discover_tables, in_list, merge_column_groups, read_csv, row_counts,
                             scan, select_columns, usable_table_names)
from tabsync.sources.catalog import catalog_env
from tabsync.sources.csv import csv_records
from tabsync.spec import FieldMeta, Ref, TableSpec
from tabsync.storage import materialise


def test_untidy_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes('﻿"Id","Rel__r.Key","T"\r\n"1","k","a ""quoted"", line\r\nbreak"\r\n\r\n"2",,\r\n"3"\r\n"4","k","x","too long"\r\n'.encode())
    got = sorted(tuple(r) for r in read_csv(spark, str(path)).collect())
    assert got == [("1", "k", 'a "quoted", line\r\nbreak'), ("2", None, None), ("3", None, None), ("4", "k", "x")]


def test_csv_over_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(b'\n"a\nb",c,,C\n"x\n\n\ny",1\n,2 "" 3\r\n"open\n3,')
    back = read_csv(spark, str(path))
    assert back.columns == ["a\nb", "c1", "_c2", "C3"]
    assert sorted(((r[0], r[1]) for r in back.collect()), key=str) == [("open\n3,", None), ("x\n\n\ny", "1"), (None, '2 "" 3')]
    assert read_csv(spark, str(path), "n string, `k.v` string").where("n IS NULL").first()["k.v"] == '2 "" 3'


@pytest.mark.parametrize("size", [1500, 1 << 20])
def test_csv_blocks_inside_values(spark, tmp_path, size):
    """Blocks begin anywhere: in the header, in quotes, in runs of doubled quotes, in blank lines of a value."""
    rnd = random.Random(size)
    bits = ['"', '""', "\n", "\r\n", ",", "a", "ü", " ", "x" * 40, "\n\n", "\r", '","', '"\n"']
    rows = [(str(i), "".join(rnd.choices(bits, k=rnd.choice((0, 3, 40, 500)))), rnd.choice(("", "z", 'z"z', 'z""', "z\n"))) for i in range(100)]
    bare = lambda v: '"' + v.replace('"', '""') + '"' if "\n" in v or not v else v
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n")):
        lines = [f'"{a}","{b.replace(chr(34), chr(34) * 2)}",{bare(c)}' for a, b, c in rows]
        (tmp_path / name).write_bytes((end.join(['id,"v",w', *lines]) + end).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        records = csv_records(spark, str(tmp_path))
        got = sorted((tuple(r) for r in read_csv(spark, str(tmp_path)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert records.where("is_header").count() == 2
    assert got == sorted(((a, b or None, c or None) for a, b, c in rows * 2), key=str)


def test_csv_nothing(spark, tmp_path):
    (tmp_path / "only.csv").write_bytes(b"a,b\n")
    back = read_csv(spark, str(tmp_path / "only.csv"))
    assert (back.columns, back.collect()) == (["a", "b"], [])
    (tmp_path / "empty.csv").write_bytes(b"")
    assert read_csv(spark, str(tmp_path / "empty.csv")).columns == []


def test_csv_text_form(spark, frame, tmp_path):
    df = frame("k string, r__key string, b boolean, n double", ("x", "p", True, 1.5), (None, None, None, None))
    write_csv(df, str(tmp_path / "out"), {"r__key": "Rel.Key"})
    back = read_csv(spark, str(tmp_path / "out"))
    assert back.columns == ["k", "Rel.Key", "b", "n"]
    assert sorted(map(tuple, back.collect()), key=str) == [("x", "p", "TRUE", "1.5"), (None,) * 4]


def test_manifest_line(spark, frame):
    spec = TableSpec("t", "id", "k", active_col="on")
    row = build_manifest(spark, [(manifest_entry("full", 1, 2, "tier-1/02-t", spec), frame("a int", (1,), (2,)))]).first()
    assert (row["rows"], row["operation"], row["notes"], row["pass2"]) == (2, "upsert", "deactivate on", False)
    assert build_manifest(spark, []).count() == 0


def test_columns_to_read():
    metas = [FieldMeta("t", "CreatedDate"), FieldMeta("t", "a"), FieldMeta("t", "calc", calculated=True),
             FieldMeta("t", "ref", "reference", ("p",), calculated=True), FieldMeta("t", "addr", "address"),
             FieldMeta("t", "num", auto_number=True), FieldMeta("t", "k", auto_number=True), FieldMeta("t", "no"), FieldMeta("t", "never")]
    spec = TableSpec("t", "Id", "k", exclude=("no", "k"))
    assert select_columns(spec, metas, ["never", "Id"]) == ["Id", "a", "ref", "k"]
    assert select_columns(spec.with_(include=("b", "a")), metas) == ["Id", "k", "b", "a"]


def test_filter_and_projection_reach_the_files(spark):
    env = {"orders": spark.read.parquet("/root/testdata/sf0.001/orders.parquet")}
    df = scan(env, TableSpec("orders", "o_orderkey", filter="o_custkey = 5", include=("o_orderstatus",)))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,5)" in text and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text


def test_table_names_and_counts(spark, frame):
    names = ["b", "a__History", "a__Share", "ab", "c"]
    assert usable_table_names(names) == ["ab", "b", "c"] and usable_table_names(names, ["a"]) == ["ab"]
    env = {"ab": frame("x int", (1,)), "b": frame("x int", (1,)).where("false")}
    counts = row_counts(env, ["ab", "b", "zz", TableSpec("ab", filter="nonsense > 1")])
    assert sorted(map(tuple, counts.collect())) == [("ab", -1), ("ab", 1), ("b", 0), ("zz", -1)]
    tables, fields = discover_tables(env, min_records=1)
    assert [r["table"] for r in tables.collect()] == ["ab"] and fields.count() == 1


def test_inventory_of_a_catalog(spark, frame):
    frame("x int, y string", (1, "a")).createOrReplaceTempView("inventory_me")
    env = catalog_env(spark, prefixes=["inventory"])
    got = {r["field"]: r["type"] for r in column_inventory(spark, env, [TableSpec("inventory_me", refs=(Ref("y", ("p",)),))]).collect()}
    assert got == {"x": "int", "y": "reference"}
    spark.catalog.dropTempView("inventory_me")


def test_column_groups_and_long_lists(frame, rows):
    merged = merge_column_groups([frame("id int, a int, b int", (1, 1, 1), (2, 2, 2)), frame("id int, b int, c int", (2, None, 5), (3, 9, 9))], "id")
    assert rows(merged) == [(1, 1, 1, None), (2, 2, None, 5), (3, None, 9, 9)]
    df = frame("v int", *[(i,) for i in range(50)])
    assert in_list(df, "v", list(range(10, 30_000))).count() == 40


def test_preview_and_discovery(frame):
    specs = [TableSpec("p", "id"), TableSpec("c", "id", "k", refs=(Ref("p_id", ("p",)), Ref("me", ("c",)))), TableSpec("h", resolve_only=True)]
    env = {"p": frame("id int", (1,)), "c": frame("id int, k string, p_id int, me int", (1, "a", 1, None), (2, "b", 1, 1)), "h": frame("Id int", (1,))}
    assert [(r["order"], r["tier"], r["table"], r["records"]) for r in plans.plan(env, specs).collect()] == [(1, 0, "p", 1), (2, 1, "c", 2), (None, None, "TOTAL", 3)]
    report, fields, edges = plans.discover(env, specs)
    got = {r["table"]: r for r in report.collect()}
    assert got["p"]["gap"] == "Referenced by 1 table(s) but has no key" and got["c"]["self_references"] == 1
    assert [(r["child"], r["parent"]) for r in edges.collect()] == [("c", "p")]
    assert [r["table"] for r in plans.discover(env, specs, min_records=2)[0].collect()] == ["c"]


def test_a_missing_table_is_an_error_of_the_run(frame):
    with pytest.raises(ValueError):
        plans.compare({}, {}, [TableSpec("a")], only="b")


def test_csv_lines_move_once(spark, tmp_path):
    """Lines of blocks with values over lines are followed and put together in one pass; the result reads what that wrote and moves a part of a block at most."""
    (tmp_path / "in.csv").write_bytes(b'n,v\n' + b'1,"a\nb"\n2,c\n' * 50)
    records = csv_records(spark, str(tmp_path / "in.csv"))
    assert "Window" not in records._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["record"] for r in records.collect()) == ['1,"a\nb"'] * 50 + ["2,c"] * 50 + ["n,v"]


def test_written_tables_are_small(spark, tmp_path):
    """Tables written to be read again, and bundles, are zstd."""
    materialise(spark.range(1000), path=str(tmp_path / "t"))
    write_table(spark.range(1000).toDF("id"), str(tmp_path / "b"))
    for name in ("t", "b"):
        files = list((tmp_path / name).glob("*.parquet"))
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups} == {"ZSTD"}


def test_roundtrip_broadcasts_no_many_customers(spark, tmp_path, monkeypatch):
    """20,000 customers are small in files alone; neither the load nor the comparison broadcasts them."""
    n = F.col("id")
    made = {"region": spark.range(1).select(n.cast("int").alias("r_regionkey"), F.lit("R").alias("r_name")),
            "nation": spark.range(2).select(n.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), n).alias("n_name"), F.lit(0).alias("n_regionkey")),
            "customer": spark.range(20_000).select((n + 10_000).alias("c_custkey"), F.when(n == 5, F.lit(None)).otherwise(F.concat(F.lit("C"), n + 10_000)).alias("c_name"), (n % 2).cast("int").alias(
                "c_nationkey"), F.lit(1.0).alias("c_acctbal"), F.lit("M").alias("c_mktsegment")),
            "supplier": spark.range(3).select(n.alias("s_suppkey"), F.concat(F.lit("S"), n).alias("s_name"), F.lit(0).alias("s_nationkey"), F.lit(1.0).alias("s_acctbal")),
            "part": spark.range(4).select(n.alias("p_partkey"), F.lit("p").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice")),
            "orders": spark.range(50).select(n.alias("o_orderkey"), (n + 10_010).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), n.cast("double").alias("o_totalprice"),
                                             F.lit("2024-01-01").cast("timestamp").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
            "lineitem": spark.range(100).select((n % 50).alias("l_orderkey"), (n % 4).alias("l_partkey"), (n % 3).alias("l_suppkey"), (n % 7).cast("int").alias("l_linenumber"), n.cast("double").alias("l_quantity"))}
    for name, df in made.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"), compression="zstd")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
        seen, write = [], lookup.materialise_counted
        monkeypatch.setattr(lookup, "materialise_counted", lambda df, *a, **kw: seen.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a, **kw))
        out = queries.export_load_roundtrip(spark, str(tmp_path))
        joins = [s for text in seen for s in text.split("\n") if "Join" in s and "custkey" in s]
        assert joins and not [s for s in joins if "Broadcast" in s]
        rows = [r.asDict() for r in out.where("table IN ('orders', 'lineitem')").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {(r["table"], r["source"], r["target"], r["identical"], r["new"], r["deleted"]) for r in rows} == {("orders", 50, 50, 50, 0, 0), ("lineitem", 100, 100, 100, 0, 0)}
