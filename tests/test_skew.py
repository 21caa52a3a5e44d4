"""A third of all rows, or more, under one key."""

from pyspark.sql import functions as F

from tabsync.operators import clean, crosswalk, diff, lookup
from tabsync.spec import Ref, TableSpec
from tabsync.storage import number_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(n).select("id", key.alias("k"), (F.col("id") % 7).alias("v"))


def test_duplicates_are_reduced_before_the_shuffle(spark):
    out = clean.dedupe_keep_last(hot(spark).repartition(6), "k", ["id"])
    text = plan(out)
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    assert out.where("k = 'hot'").collect()[0]["id"] == 2997 and out.count() == 2001


def test_diff_reuses_the_partitioning_of_the_reduction(spark):
    df = hot(spark)
    joined = diff.join_snapshots(df, df, TableSpec("t", "id", "k"), ["v"])
    assert plan(joined).count("Exchange hashpartitioning") == 2


def test_equal_rows_are_counted_before_the_shuffle(spark):
    text = plan(diff.fingerprint_counts(hot(spark), hot(spark), ["k"]))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("HashAggregate") == 2


def test_rank_of_a_large_group_is_gapless_and_spread(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), "id")
    ranked = diff.rank_in_group(df, "g", "id")
    got = ranked.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()
    assert tuple(got) == (1, 5000, 5000)
    largest = (df.withColumn("b", F.substring(F.md5(F.col("id").cast("string")), 1, 2)).groupBy("b").count()
               .agg(F.max("count")).first()[0])
    assert largest < 50  # what one window sees of the group
    again = diff.rank_in_group(df.repartition(7), "g", "id")
    assert again.exceptAll(ranked.select(*again.columns)).count() == 0


def test_row_numbers_are_gapless_with_a_frequent_leading_value(spark):
    df = hot(spark).repartition(5)
    out = number_rows(df, ["k", "id"])
    assert out.agg(F.count_distinct("row_no"), F.min("row_no"), F.max("row_no")).first()[:] == (3000, 0, 2999)
    assert out.where("k = 'hot'").agg(F.max("row_no") - F.min("row_no")).first()[0] == 999
    first = out.orderBy("row_no").select("k", "id").limit(5).collect()
    assert first == df.orderBy("k", "id").select("k", "id").limit(5).collect()


def test_row_numbers_with_repeated_rows(spark):
    df = spark.range(100).select(F.lit(1).alias("a"))
    assert number_rows(df, ["a"]).agg(F.count_distinct("row_no"), F.count("*")).first()[:] == (100, 100)


def test_same_result_for_any_partitioning(spark):
    df = hot(spark)
    want = sorted(map(tuple, clean.dedupe_keep_last(df, "k", ["id"]).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            shuffled = df.orderBy(F.rand(3))
            assert sorted(map(tuple, clean.dedupe_keep_last(shuffled, "k", ["id"]).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lookups_deal_out_frequent_values_and_nulls(spark):
    """Half of the rows under one key, a fifth without one: no task gets much more than its share, and no row is lost or doubled."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    df = spark.range(20_000).select("id", key.alias("k"))
    pairs = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1)], "k string, v bigint")).groupBy("k").agg(F.max("v").alias("v"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert lookup.hot_values(df, [F.col("k")]) == [["hot"]]
        out = lookup.look_up(df, [lookup.Lookup(F.col("k"), pairs, "v")])
        assert "BroadcastHashJoin" in plan(out) or "BroadcastExchange" in plan(out)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16
        want = {r.id: -1 if r.id % 2 == 0 else None if r.id % 5 == 0 else r.id for r in df.collect()}
        assert {r.id: r.v and int(r.v) for r in out.collect()} == {**want, 0: -1}
        inside, outside = clean.route_by_membership(df.withColumnRenamed("k", "fk"), "fk", pairs.where("v % 3 = 0 OR v = -1").select("k"))
        assert inside.where("fk = 'hot'").count() == 10_000 and inside.count() + outside.count() == 20_000
        assert outside.where("fk IS NULL").count() == 2_000
        found = crosswalk.match_by_name(df, pairs.select("k", F.col("v").alias("tid")), "k", "id", "tid")
        assert found.count() == 20_000 and found.where("target_id = '-1'").count() == 10_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_that_cannot_find_anything_stay(spark, tmp_path):
    """Of a large lookup over rows as read, only those with a value that is not frequent move; a second lookup does not repeat the first."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    spark.range(2_000).select("id", key.alias("k"), (F.col("id") + 1).cast("string").alias("j")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    pairs = spark.range(1_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").cast("string").alias("v")).union(
        spark.createDataFrame([("hot", "h")], "k string, v string"))
    small = spark.range(500).select(F.col("id").cast("string").alias("j"), F.col("id").cast("string").alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        one = lookup.look_up(df, [lookup.Lookup(F.col("k"), pairs, "v")])
        assert "__lookup_own" not in plan(one) and lookup.only_read(df) and not lookup.only_read(one)
        moved = [m for m in plan(one).split("\n") if "Exchange hashpartitioning" in m]
        assert len(moved) == 2 and "isnotnull" in plan(one) and "xxhash64" not in plan(one)
        want = {i: "h" if i % 2 == 0 else None if i % 5 == 0 or i >= 1_000 else str(i) for i in range(2_000)}
        assert {r.id: r.v for r in one.collect()} == want and one.count() == 2_000
        two = lookup.look_up(df, [lookup.Lookup(F.col("k"), pairs, "v"), lookup.Lookup(F.col("j"), small, "w")])
        assert two.columns == ["id", "k", "j", "v", "w"]
        assert {r.id: (r.v, r.w) for r in two.collect()} == {i: (v, str(i + 1) if i < 499 else None) for i, v in want.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def under_threshold(spark, threshold, run):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        return run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_small_in_files_alone_are_not_broadcast(spark, tmp_path):
    """Ids in order are packed: their files lie below the threshold, in memory they take ten times as much."""
    df = spark.range(30_000).select("id", F.concat(F.lit("k"), F.col("id") + 10_000).alias("k"))
    spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") + 10_000).alias("k"), (F.col("id") + 10_000).cast("string").alias("v")).coalesce(1).write.parquet(
        str(tmp_path / "pairs"), compression="zstd")
    pairs = spark.read.parquet(str(tmp_path / "pairs"))

    def run():
        assert lookup.broadcastable(pairs)
        out = lookup.look_up(df, [lookup.Lookup(F.col("k"), pairs, "v")])
        assert "Broadcast" not in plan(out) and "SortMergeJoin" in plan(out)
        assert {r.id: r.v for r in out.collect()} == {i: str(i + 10_000) if i < 20_000 else None for i in range(30_000)} and out.count() == 30_000
        few = lookup.look_up(df, [lookup.Lookup(F.col("k"), pairs.where("v < '10010'"), "v")])
        assert "BroadcastHashJoin" in plan(few) and few.where("v IS NOT NULL").count() == 10
    under_threshold(spark, "200k", run)


def test_keys_are_rewritten_without_a_broadcast_of_many(spark, tmp_path):
    spec = TableSpec("t", "id", refs=(Ref("p", ("parent",), "parent"),))
    df = spark.range(30_000).select("id", F.concat(F.lit("k"), F.col("id") + 10_000).alias("parent__key"))
    spark.range(20_000).select(F.lit("parent").alias("table"), F.lit("key").alias("key_field"), F.concat(F.lit("k"), F.col("id") + 10_000).alias("source_key"), F.concat(
        F.lit("n"), F.col("id") + 10_000).alias("target_key")).coalesce(1).write.parquet(str(tmp_path / "xwalk"), compression="zstd")

    def run():
        out = crosswalk.rewrite_keys(df, spec, spark.read.parquet(str(tmp_path / "xwalk")))
        assert "Broadcast" not in plan(out)
        assert {r.id: r.parent__key for r in out.collect()} == {i: f"{'n' if i < 20_000 else 'k'}{i + 10_000}" for i in range(30_000)}
    under_threshold(spark, "200k", run)


def test_second_large_lookup_moves_no_key_of_its_own(spark, tmp_path):
    """Keys by which rows are dealt out are worked out on the way; rows without a value and with a frequent one are still spread."""
    spark.range(8_000).select("id", F.concat(F.lit("a"), "id").alias("a"), F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("b"), "id")).alias("b")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    pairs = lambda c: df.groupBy(F.col(c).alias("k")).agg(F.max("id").alias("v"))

    def run():
        out = lookup.look_up(df, [lookup.Lookup(F.col("a"), pairs("a"), "x"), lookup.Lookup(F.col("b"), pairs("b"), "y")])
        assert "__lookup_own" not in "".join(s for s in plan(out).split("\n") if "Project" in s and "xxhash64" in s)
        assert {r.id: (r.x, r.y) for r in out.collect()} == {i: (str(i), "7998" if i % 2 == 0 else None if i % 5 == 0 else str(i)) for i in range(8_000)}
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 2 * 8_000 / 16
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        under_threshold(spark, "-1", run)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
