"""The same answer at every size, number of columns and kind of value."""

from itertools import product

from pyspark.sql import functions as F

from tabsync.functions import backfill_key, differs, fingerprint_label
from tabsync.operators import crosswalk, diff
from tabsync.sources.tables import MAX_LITERALS, in_list
from tabsync.spec import Ref, TableSpec


def test_long_lists_of_text_match_numbers_like_short_ones(frame):
    df = frame("k bigint", (1,), (5,), (None,))
    for n in (10, MAX_LITERALS, MAX_LITERALS + 1):
        assert [r.k for r in in_list(df, "k", [str(i) for i in range(3, 3 + n)]).collect()] == [5]
    assert in_list(df, "k", ["no number", "1"]).count() == 1


def test_labels_tell_instants_and_bytes_apart(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("SELECT timestamp'2024-11-03 08:30:00Z' AS t, X'FF' AS b UNION ALL SELECT timestamp'2024-11-03 09:30:00Z', X'FE'")
        for c in ("t", "b"):
            assert df.select(fingerprint_label(df, [c]).alias("l")).distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_long_ids_keep_their_difference(frame):
    df = frame("k string, id string", (None, "customer-000000001"), (None, "customer-000000002"))
    assert df.select(backfill_key("k", "id", "C")).distinct().count() == 2


def test_an_id_of_two_parents_stays_one_row(frame):
    xwalk = frame("table string, source_id string, target_id string", ("supplier", "5", "59"), ("customer", "5", "53"), ("supplier", "6", "60"))
    spec = TableSpec("t", "id", refs=(Ref("f", ("customer", "supplier"), "owner"),))
    got = crosswalk.resolve_raw_refs(frame("id int, f bigint", (1, 5), (2, 6), (3, 7)), spec, xwalk, pattern=None)
    assert sorted((r.id, r.f) for r in got.collect()) == [(1, 53), (2, 60), (3, None)]


#: Values of one type each that are easily taken for one another.
ALIKE = {
    "string": ["CAST(NULL AS STRING)", "''", "'a'", "'A'", "CAST(X'FF' AS STRING)", "CAST(X'FE' AS STRING)", "'\\u0000'", "'1:a'"],
    "binary": ["CAST(NULL AS BINARY)", "X''", "X'FF'", "X'FFFF'"],
    "double": ["CAST(NULL AS DOUBLE)", "0D", "-0D", "double('NaN')", "1e300D", "0.1D", "0.30000000000000004D", "0.3D"],
    "float": ["float('NaN')", "float('0.1')", "float('-0')", "float('0')", "float('1e-45')"],
    "decimal": ["CAST(1.10 AS DECIMAL(20,2))", "CAST(1.1 AS DECIMAL(20,2))", "CAST(NULL AS DECIMAL(20,2))", "CAST(-1.1 AS DECIMAL(20,2))"],
    "timestamp": ["timestamp'2024-11-03 08:30:00Z'", "timestamp'2024-11-03 09:30:00Z'", "timestamp'2024-11-03 09:30:00.000001Z'", "CAST(NULL AS TIMESTAMP)"],
    "local": ["timestamp_ntz'2024-11-03 01:30:00'", "timestamp_ntz'2024-11-03 01:30:00.000001'"],
    "date": ["date'2024-11-03'", "CAST(NULL AS DATE)"],
    "boolean": ["true", "false", "CAST(NULL AS BOOLEAN)"],
    "array": ["array('a', 'b')", "array('a,b')", "array('ab')", "array('a', '', 'b')", "array('a', NULL, 'b')", "CAST(array() AS ARRAY<STRING>)",
              "CAST(NULL AS ARRAY<STRING>)", "array(CAST(X'FF' AS STRING))", "array(CAST(X'FE' AS STRING))", "array('-')"],
    "struct": ["struct('a' AS x, 0D AS y)", "struct('a' AS x, -0D AS y)", "struct(CAST(NULL AS STRING) AS x, 0D AS y)", "struct('' AS x, 0D AS y)"],
    "map": ["map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)", "map('a', 1)", "map('a', 2)"],
    "deep": ["array(array(1), array(2, 3))", "array(array(1, 2), array(3))", "array(array(1, 2, 3))", "array(CAST(NULL AS ARRAY<INT>))"],
}


def test_hashes_tell_values_apart_exactly_as_comparison_does(spark):
    for kind, values in ALIKE.items():
        one = spark.sql(" UNION ALL ".join(f"SELECT {i} AS i, {v} AS v" for i, v in enumerate(values)))
        labelled = one.withColumn("l", fingerprint_label(one, ["v"]))
        pairs = labelled.crossJoin(labelled.select(F.col("i").alias("j"), F.col("v").alias("w"), F.col("l").alias("m")))
        t = one.schema["v"].dataType
        got = {(r.i, r.j): (r.same, r.equal) for r in pairs.select("i", "j", (F.col("l") == F.col("m")).alias("same"),
                                                                     (~differs(F.col("v"), F.col("w"), t, t)).alias("equal")).collect()}
        assert len(got) == len(values) ** 2
        for (i, j), (same, equal) in got.items():
            assert same == equal, (kind, values[i], values[j])


def test_columns_never_run_into_each_other(spark):
    texts = ["", "a", "1:a", "a1:", "0:"]
    df = spark.createDataFrame(list(product(texts, texts)), "a string, b string")
    assert df.select(fingerprint_label(df, ["a", "b"]).alias("l")).distinct().count() == len(texts) ** 2


def test_the_number_of_columns_changes_no_answer(spark):
    """Invalid UTF-8 in one of ten columns."""
    more = ", ".join(f"{i} AS c{i}" for i in range(9))
    src, tgt = (spark.sql(f"SELECT 1 AS id, 'k' AS k, CAST(X'{x}' AS STRING) AS v, {more}") for x in ("FF", "FE"))
    spec = TableSpec("t", "id", "k")
    assert [diff.diff_by_key(src, tgt, spec, digest=d).first()["status"] for d in (False, True)] == ["modified", "modified"]
    assert diff.diff_by_key(src, tgt, spec, ["v"]).first()["status"] == "modified"
