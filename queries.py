"""One query per operator, over whole tables of the given folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures_sql import table
from tabsync import plans
from tabsync.functions import backfill_key as backfill
from tabsync.operators import clean, crosswalk, diff, graph, load, log, lookup, resolve, subset
from tabsync.sinks.bundle import (build_manifest, manifest_entry, read_table, write_csv, write_diff, write_report,
                                  write_results)
from tabsync.sources import catalog, tables
from tabsync.sources.csv import read_csv
from tabsync.spec import FieldMeta, Ref, TableSpec, by_name, load_order, table_tiers
from tabsync.storage import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDERS = TableSpec("orders", "o_orderkey", "o_orderkey", refs=(Ref("o_custkey", ("customer",), "customer"),))
CUSTOMER = TableSpec("customer", "c_custkey", "c_name", refs=(Ref("c_nationkey", ("nation",), "nation"),), name_col="c_name")
EVENTS = TableSpec("events", "event_id", "event_id", compare_ignore=("ts", "value", "props"), auto_number_key=True)
STAR = (
    TableSpec("region", "r_regionkey", "r_name", name_col="r_name"),
    TableSpec("nation", "n_nationkey", "n_name", refs=(Ref("n_regionkey", ("region",), "region"),), name_col="n_name"),
    CUSTOMER,
    TableSpec("supplier", "s_suppkey", "s_name", refs=(Ref("s_nationkey", ("nation",), "nation"),), name_col="s_name"),
    TableSpec("part", "p_partkey"),
    TableSpec("orders", "o_orderkey", refs=(Ref("o_custkey", ("customer",), "customer"),)),
    TableSpec("lineitem", "l_id", refs=(Ref("l_orderkey", ("orders",), "order"), Ref("l_partkey", ("part",), "part"),
                                        Ref("l_suppkey", ("supplier",), "supplier"))),
)
ALL_TABLES = STAR + (
    TableSpec("documents", "doc_id"), TableSpec("labels", "doc_id", refs=(Ref("doc_id", ("documents",), "document"),)),
    TableSpec("events", "event_id"), TableSpec("pages", "page_id", "url"), TableSpec("benchmark", "item_id"),
    TableSpec("embeddings", "vec_id"),
    TableSpec("conversations", "turn_id", refs=(Ref("reply_to", ("conversations",), "reply"),)),
)
SALES = TableSpec("sales", "id", "okey", active_col="active")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def star(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    env = {s.name: table(spark, d, s.name) for s in STAR if s.name != "lineitem"}
    env["lineitem"] = table(spark, d, "lineitem_ids")
    return env


# Comparing snapshots

@query
def diff_by_key(spark, d):
    return diff.diff_by_key(table(spark, d, "orders"), table(spark, d, "orders_tgt"), ORDERS).drop("name")


@query
def diff_documents(spark, d):
    """Long texts, compared whole by hash."""
    spec = TableSpec("documents", "doc_id", "doc_id")
    return diff.diff_by_key(table(spark, d, "documents"), table(spark, d, "documents_tgt"), spec, digest=True).drop("name")


@query
def diff_changes(spark, d):
    joined = diff.join_snapshots(table(spark, d, "orders_money"), table(spark, d, "orders_tgt_money"), ORDERS)
    return diff.diff_changes(joined, "orders")


@query
def diff_summary(spark, d):
    src = {"orders": table(spark, d, "orders"), "customer": table(spark, d, "customer"), "events": table(spark, d, "events")}
    tgt = {"orders": table(spark, d, "orders_tgt"), "customer": table(spark, d, "customer_tgt"),
           "events": table(spark, d, "events_tgt")}
    return diff.with_total(diff.diff_all(src, tgt, (ORDERS, CUSTOMER, EVENTS), keep=False).summary)


@query
def diff_duplicate_keys(spark, d):
    spec = TableSpec("lineitem", "l_suppkey", "l_key", order_cols=_LINE_ORDER)
    lines = table(spark, d, "lineitem_keys")
    rows = diff.diff_by_key(lines, lines, spec, ["l_quantity", "l_extendedprice"])
    return diff.diff_summary(rows, lines, lines, spec)


@query
def diff_fingerprint_counts(spark, d):
    return diff.fingerprint_counts(table(spark, d, "events"), table(spark, d, "events_tgt"), ["user_id", "event_type"])


@query
def diff_fingerprint_summary(spark, d):
    return diff.fingerprint_summary(diff_fingerprint_counts(spark, d))


@query
def diff_fingerprint_rows(spark, d):
    rows = diff.diff_by_fingerprint(table(spark, d, "events"), table(spark, d, "events_tgt"), EVENTS)
    return rows.select("status", "source_id", "target_id")


@query
def surplus(spark, d):
    return diff.surplus(table(spark, d, "events"), table(spark, d, "events_tgt"), ["user_id", "event_type"])


@query
def extract_delta(spark, d):
    src = table(spark, d, "orders")
    rows = diff.diff_by_key(src, table(spark, d, "orders_tgt"), ORDERS)
    return diff.extract_delta(src, rows, "o_orderkey")


@query
def diff_report_files(spark, d):
    """The report as JSON files, read back."""
    path = new_path(spark, "report")
    write_diff(diff.diff_by_key(table(spark, d, "orders"), table(spark, d, "orders_tgt"), ORDERS), path)
    schema = "table string, status string, strategy string, key string, source_id string, target_id string"
    return spark.read.schema(schema).json(path)


@query
def diff_report_summary(spark, d):
    """The whole report on disk, its summary read back."""
    specs = (ORDERS, CUSTOMER)
    src = {"orders": table(spark, d, "orders"), "customer": table(spark, d, "customer")}
    tgt = {"orders": table(spark, d, "orders_tgt"), "customer": table(spark, d, "customer_tgt")}
    path = new_path(spark, "report")
    write_report(diff.diff_all(src, tgt, specs), path)
    return spark.read.schema("table string, strategy string, " + ", ".join(f"{c} bigint" for c in diff.COUNTERS)).json(f"{path}/summary")


@query
def diff_names(spark, d):
    """Compared rows with the name shown for them, the source's where there is one."""
    spec = CUSTOMER.with_(key="c_custkey", name_col=None)
    sides = [table(spark, d, t).withColumnRenamed("c_name", "Name").drop("c_mktsegment") for t in ("customer", "customer_tgt")]
    return diff.diff_by_key(*sides, spec).select("key", "status", "name")


@query
def order_columns(spark, d):
    """Key first, the others by name; positions tell the order."""
    out = resolve.order_columns(table(spark, d, "orders_money"), "o_orderkey")
    return out.select(F.posexplode(F.array(*[F.concat_ws("=", F.lit(c), F.col(c).cast("string")) for c in out.columns])), "o_orderkey").select(
        "o_orderkey", F.col("pos").alias("place"), F.col("col").alias("cell"))


# Duplicates, splits, rejects

_LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus")
_LINE_SHOWN = ("l_key", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query
def dedupe_keep_last(spark, d):
    return clean.dedupe_keep_last(table(spark, d, "lineitem_keys"), "l_key", _LINE_ORDER).select(*_LINE_SHOWN)


@query
def duplicates_removed(spark, d):
    return clean.duplicates_removed(table(spark, d, "lineitem_keys"), "l_key")


@query
def split_by_key(spark, d):
    named, unnamed = clean.split_by_key(table(spark, d, "customer_keys"), "c_key")
    return clean.union_results([named.withColumn("operation", F.lit("upsert")),
                                unnamed.withColumn("operation", F.lit("insert"))])


@query
def backfill_key(spark, d):
    df = table(spark, d, "customer_keys")
    return df.select("c_custkey", backfill("c_key", "c_custkey", "CUST").alias("c_key"))


@query
def classify_rejects(spark, d):
    return clean.classify_rejects(table(spark, d, "rejects"))


@query
def retry_rejects(spark, d):
    def submit(rows: DataFrame, attempt: int) -> tuple[DataFrame, DataFrame]:
        taken = F.col("o_custkey") % (attempt + 1) == 0
        error = F.when(F.col("o_custkey") % 5 == 0, "FIELD_INTEGRITY_EXCEPTION").otherwise("UNABLE_TO_LOCK_ROW")
        return rows.where(taken), rows.where(~taken).withColumn("error", error)

    ok, bad, _ = load.retry_rejects(table(spark, d, "rejects"), submit)
    return clean.union_results([ok.withColumn("outcome", F.lit("recovered")), bad.withColumn("outcome", F.lit("failed"))])


@query
def route_by_membership(spark, d):
    """Members are target ids of the suppliers of one nation; lines carry source ids."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    suppliers = table(spark, d, "supplier_tgt")
    members = suppliers.where(F.col("s_nationkey") % 20 == 13).select("s_suppkey")
    xwalk = table(spark, d, "supplier").select(
        F.lit("supplier").alias("table"), F.col("s_suppkey").cast("string").alias("source_id"),
        (F.col("s_suppkey") * 10 + 3).cast("string").alias("target_id"))
    first, rest = clean.route_by_membership(lines, "l_suppkey", members, xwalk)
    return first.withColumn("batch", F.lit("first")).unionByName(rest.withColumn("batch", F.lit("rest")))


# References

@query
def resolve_refs_orders(spark, d):
    env = {"customer": table(spark, d, "customer")}
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return resolve.resolve_references(orders, ORDERS, resolve.id_maps(env, [CUSTOMER]))


_LINE = TableSpec("lineitem", "l_id", refs=STAR[-1].refs)
_LINE_PARENTS = (TableSpec("orders", "o_orderkey", "o_key"), TableSpec("part", "p_partkey", "p_key", filter="p_size <= 25"),
                 TableSpec("supplier", "s_suppkey", "s_name"))


def _line_maps(spark, d):
    env = {"orders": table(spark, d, "order_keys"), "part": table(spark, d, "part_keys"), "supplier": table(spark, d, "supplier")}
    return resolve.id_maps(env, _LINE_PARENTS)


@query
def resolve_refs_lineitem(spark, d):
    """Three parents, one of them filtered, so that some references stay raw."""
    return resolve.resolve_references(table(spark, d, "lineitem_ids"), _LINE, _line_maps(spark, d), keep_source_id=False)


@query
def resolve_polymorphic(spark, d):
    spec = TableSpec("events", "event_id", refs=(Ref("party_id", ("customer", "supplier"), "party"),))
    env = {"customer": table(spark, d, "customer_party"), "supplier": table(spark, d, "supplier_party")}
    maps = resolve.id_maps(env, [TableSpec(t, "party_id", "party_key") for t in env])
    return resolve.resolve_references(table(spark, d, "event_party"), spec, maps, keep_source_id=False)


@query
def unresolved_refs(spark, d):
    parent = CUSTOMER.with_(filter="c_mktsegment = 'BUILDING'")
    maps = resolve.id_maps({"customer": table(spark, d, "customer")}, [parent])
    return resolve.unresolved_references(resolve.resolve_references(table(spark, d, "orders"), ORDERS, maps), ORDERS)


_TURNS = TableSpec("turns", "id", "turn_key", refs=(Ref("reply_to", ("turns",), "reply"),))


@query
def self_ref_pass2(spark, d):
    turns = table(spark, d, "turns")
    return resolve.self_ref_pass2(turns, _TURNS, resolve.id_map({"turns": turns}, _TURNS))["reply_to"]


@query
def bind_parents(spark, d):
    orders = table(spark, d, "orders_check").select("o_orderkey", "customer__key")
    known = table(spark, d, "customer").where("c_custkey % 7 <> 0")
    env = {"orders": table(spark, d, "orders"), "customer": known.select(
        (F.col("c_custkey") * 10 + 3).alias("c_custkey"),
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("c_key"))}
    specs = {"customer": TableSpec("customer", "c_custkey", "c_key")}
    out = load.bind_parents(orders, ORDERS, env, specs)
    return out.select("o_orderkey", "o_custkey", F.array_join("_unbound", ";").alias("unbound"))


# Graphs and subsets

@query
def record_tiers(spark, d):
    turns = table(spark, d, "turns")
    edges = turns.where("reply_to IS NOT NULL").select(F.col("id").alias("child"), F.col("reply_to").alias("parent"))
    return graph.dependency_tiers(edges, turns.select("id"))


@query
def record_tiers_parallel_edges(spark, d):
    tiers = graph.dependency_tiers(table(spark, d, "row_edges"), table(spark, d, "row_nodes"))
    return tiers.select("node", "tier", "in_cycle")


@query
def record_tiers_cycle(spark, d):
    return graph.dependency_tiers(table(spark, d, "turn_edges_cycle"), table(spark, d, "turns").select("id"))


def _everything(spark, d):
    env = {**star(spark, d), **{t: table(spark, d, t) for t in ("documents", "labels", "events", "pages", "benchmark", "embeddings")}}
    env["conversations"] = table(spark, d, "turns").withColumnRenamed("id", "turn_id")
    return env


@query
def table_tiers_report(spark, d):
    return plans.discover(_everything(spark, d), ALL_TABLES)[0]


@query
def fk_edges(spark, d):
    """References between tables, with the number of rows on either end."""
    env = _everything(spark, d)
    _, _, edges = plans.discover(env, ALL_TABLES)
    counts = catalog.row_counts(env, [s.name for s in ALL_TABLES])
    size = lambda end: counts.select(F.col("table").alias(end), F.col("records").alias(f"{end}_rows"))
    return edges.join(size("child"), "child").join(size("parent"), "parent")


@query
def discover_tables(spark, d):
    env = {**_everything(spark, d), "orders__History": table(spark, d, "orders")}
    found, fields = catalog.discover_tables(env, ("o", "c", "l"), 1)
    widths = fields.groupBy("table").agg(F.count(F.lit(1)).alias("columns"))
    return found.join(widths, "table")


@query
def row_counts(spark, d):
    specs = [TableSpec("orders", filter="o_orderstatus = 'F'"), TableSpec("lineitem", filter="l_quantity > 25"),
             TableSpec("customer"), TableSpec("missing")]
    return catalog.row_counts({t: table(spark, d, t) for t in ("orders", "lineitem", "customer")}, specs)


@query
def key_gaps(spark, d):
    nodes = table(spark, d, "customer_keys").select(F.col("c_custkey").alias("node"), F.col("c_key").alias("key"))
    edges = table(spark, d, "orders").select(F.col("o_orderkey").alias("child"), F.col("o_custkey").alias("parent"))
    own = nodes.where("node % 2 = 1").select(F.col("node").alias("child"), F.col("node").alias("parent"))
    return graph.key_gaps(edges, nodes, own)


@query
def key_quality(spark, d):
    return graph.key_quality(table(spark, d, "customer_keys"), ["c_key", "c_mktsegment", "c_custkey"])


@query
def rank_key_candidates(spark, d):
    df = table(spark, d, "lineitem_keys")
    return graph.rank_key_candidates(df, ["l_key", "l_orderkey", "l_partkey", "l_suppkey"], ["l_partkey"]).select(
        "column", "defects", "preference")


def _ids(selection: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, [df.select(F.lit(t).alias("table"), F.col("id").cast("string").alias("id"))
                                    for t, df in selection.items()])


@query
def subset_down(spark, d):
    env = star(spark, d)
    roots = subset.root_ids(env, STAR[0], ["ASIA"])
    return _ids(subset.walk_down(env, STAR, {"region": roots}))


@query
def subset_full(spark, d):
    return _ids(subset.select_related(star(spark, d), STAR, "region", ["ASIA"]))


@query
def subset_up_from_orders(spark, d):
    """Root rows in the middle of the graph: urgent orders."""
    env = star(spark, d)
    env["orders"] = table(spark, d, "orders")
    specs = [s.with_(name_col="o_orderpriority") if s.name == "orders" else s for s in STAR]
    cut = subset.subset(env, specs, "orders", ["1-URGENT"])
    return reduce(DataFrame.union, [cut[s.name].agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(s.name).alias("table"), "rows") for s in specs if s.name in cut])


@query
def subset_cycle(spark, d):
    """Everything related to the second turns of some conversations, along references of turns to turns that may run in circles."""
    turns = table(spark, d, "turns").join(table(spark, d, "turn_edges_cycle"), F.col("id") == F.col("child"), "left").select(
        "id", "parent", F.when((F.col("turn") == 1) & (F.col("conv_id") % 5 == 0), "root").alias("mark"))
    specs = [TableSpec("turns", "id", name_col="mark", refs=(Ref("parent", ("turns",), "reply"),))]
    return _ids(subset.select_related({"turns": turns}, specs, "turns", ["root"]))


@query
def subset_portable(spark, d):
    names = ("region", "nation", "customer", "supplier")
    src = {t: table(spark, d, t) for t in names}
    tgt = {**src, "customer": table(spark, d, "customer_tgt"), "supplier": table(spark, d, "supplier_tgt").drop("s_nationkey"),
           "nation": table(spark, d, "nation_tgt")}
    specs = [s for s in STAR if s.name in names]
    both = subset.subset_portable(src, tgt, specs, "region", ["ASIA"])
    parts = [env[s.name].select(F.lit(side).alias("side"), F.lit(s.name).alias("table"), F.col(s.key).alias("key"))
             for side, env in zip(("source", "target"), both) for s in specs]
    return reduce(DataFrame.union, parts)


@query
def path_filter(spark, d):
    env = {**star(spark, d), "lineitem": table(spark, d, "lineitem_ids")}
    return tables.path_filter(env, by_name(STAR), "lineitem", ["l_orderkey", "o_custkey"], "c_mktsegment",
                            ["BUILDING", "MACHINERY"]).select("l_id", "l_orderkey", "l_quantity")


@query
def in_subquery_filter(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 5000").select("c_custkey")
    return tables.in_list(table(spark, d, "orders"), "o_custkey", rich).select("o_orderkey", "o_custkey")


@query
def in_list(spark, d):
    return tables.in_list(table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "3-MEDIUM", "it's none"]).select(
        "o_orderkey", "o_orderpriority")


# Reading

@query
def scan_spec(spark, d):
    spec = TableSpec("lineitem", "l_orderkey", "l_linenumber", filter="l_quantity > 30 AND l_returnflag = 'R'",
                     exclude=("l_shipdate", "l_tax", "l_linenumber"))
    fields = [FieldMeta("lineitem", f.name, calculated=f.name == "l_discount", auto_number=f.name == "l_linestatus")
              for f in table(spark, d, "lineitem").schema.fields]
    return tables.scan({"lineitem": table(spark, d, "lineitem")}, spec, fields)


@query
def merge_column_groups(spark, d):
    orders = table(spark, d, "orders")
    parts = [orders.select("o_orderkey", "o_custkey", "o_totalprice").where("o_orderkey % 5 <> 0"),
             orders.select("o_orderkey", "o_orderstatus"),
             orders.select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")).where("o_orderkey % 7 <> 0")]
    return tables.merge_column_groups(parts, "o_orderkey")


@query
def assign_batches(spark, d):
    return tables.assign_batches(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"),
                               ["o_orderpriority", "o_orderkey"], 1000)


@query
def csv_roundtrip(spark, d):
    """Whole texts with quotes and newlines through CSV files and back."""
    path = new_path(spark, "csv")
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", (F.col("n_chars") > 500).alias("long"))
    write_csv(docs, path)
    return read_csv(spark, path)


@query
def csv_untidy(spark, d):
    """Texts in CSV files with quotes inside bare values, short and long rows, blank lines, CRLF beside LF, and values over lines."""
    path = new_path(spark, "untidy")
    docs = table(spark, d, "documents").where("text IS NOT NULL").withColumn("part", F.floor(F.col("doc_id") / 2000))
    inner, k = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"')), F.pmod("doc_id", F.lit(5))
    line = (F.when(k == 0, F.concat_ws(",", "doc_id", inner, F.lit('a 5" pipe')))
            .when(k == 1, F.concat(F.lit("\n\r\n"), F.concat_ws(",", "doc_id", F.concat(F.lit('"'), "lang", F.lit('"'))), F.lit("\r")))
            .when(k == 2, F.concat_ws(",", "doc_id", inner, "lang", F.lit('"too\r\nlong"')))
            .when(k == 3, F.concat_ws(",", "doc_id", F.lit(""), F.lit('b "" c')))
            .otherwise(F.concat_ws(",", "doc_id", inner, inner)))
    headers = docs.select("part", F.lit(0).alias("no"), F.lit('"doc_id",text,"the ""last"""').alias("value")).distinct()
    lines = headers.union(docs.select("part", F.lit(1), line))
    lines.repartition("part").sortWithinPartitions("part", "no").select("part", "value").write.partitionBy("part").text(path)
    return read_csv(spark, path).select("doc_id", "text", F.col('`the "last"`').alias("last"))


# Cleaning

@query
def email_columns(spark, d):
    return clean.email_columns(table(spark, d, "customer_mail"))


@query
def mask_emails(spark, d):
    return clean.mask_emails(table(spark, d, "customer_mail"))[0]


@query
def mask_counters(spark, d):
    return clean.mask_emails(table(spark, d, "customer_mail"))[1]


@query
def defer_values(spark, d):
    return clean.defer_values(table(spark, d, "rules"), "rules", "rule_key", "conditions", "advanced")[0]


@query
def deferred_values(spark, d):
    return clean.defer_values(table(spark, d, "rules"), "rules", "rule_key", "conditions", "advanced")[1]


@query
def restore_deferred(spark, d):
    """Keys of every seventh rule were renumbered by the target."""
    rules = table(spark, d, "rules")
    held_back, deferred = clean.defer_values(rules, "rules", "rule_key", "conditions", "advanced")
    moved = F.col("o_orderkey") % 7 == 0
    new_key = F.concat(F.lit("T-"), F.col("o_orderkey").cast("string"))
    target = held_back.withColumn("rule_key", F.when(moved & (F.col("rule_key") != ""), new_key).otherwise(F.col("rule_key")))
    xwalk = rules.where(moved & (F.col("rule_key") != "")).select(
        F.lit("rules").alias("table"), F.lit("rule_key").alias("key_field"), F.col("rule_key").alias("source_key"),
        new_key.alias("target_key"))
    return clean.restore_deferred(target, deferred, "rule_key", ["conditions", "advanced"], xwalk)


@query
def strip_columns(spark, d):
    """Read-only, unknown and ownership columns go; so does the empty relationship, not the filled one."""
    df = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.lit("u1").alias("OwnerId"),
        F.lit("EUR").alias("CurrencyIsoCode"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer__key"),
        F.col("o_custkey").alias("clerk"), F.when(F.col("o_orderkey") < 0, "x").alias("clerk__key"),
        F.col("o_custkey").alias("agent"), F.lit(" ").alias("agent__key"))
    spec = TableSpec("orders", "o_orderkey", "o_orderkey", refs=(
        Ref("o_custkey", ("customer",), "customer"), Ref("clerk", ("user",), "clerk"), Ref("agent", ("user",), "agent")))
    meta = lambda name, **kw: FieldMeta("orders", name, **kw)
    fields = [meta("o_orderkey"), meta("o_orderstatus"), meta("o_totalprice", createable=False, updateable=False),
              meta("o_custkey", type="reference", reference_to=("customer",)), meta("OwnerId"),
              meta("clerk", type="reference", reference_to=("user",)), meta("agent", type="reference", reference_to=("user",))]
    return clean.strip_columns(df, fields, spec, resolved={"agent"})[0]


@query
def drop_listed(spark, d):
    env = clean.drop_listed({"orders": table(spark, d, "orders")}, {"orders": ["o_orderdate", "o_totalprice", "nowhere"]})
    return env["orders"]


@query
def fixups(spark, d):
    docs = table(spark, d, "documents").withColumn("reviewed", F.lit("yes"))
    return clean.fixups(docs, {"reviewed": "FALSE"}, ["text"], {"source": 4}).select("doc_id", "text", "source", "reviewed")


@query
def check_rows(spark, d):
    spec = TableSpec("orders", "o_orderkey", "o_key", refs=ORDERS.refs)
    fields = [FieldMeta("orders", "o_orderpriority", length=8), FieldMeta("orders", "o_orderstatus", nullable=False),
              FieldMeta("orders", "o_clerk", nullable=False, defaulted=True)]
    out = clean.check_rows(table(spark, d, "orders_check"), fields, spec, table(spark, d, "taken_keys"))
    return out.select("o_orderkey", F.array_join("errors", ";").alias("errors"))


# Crosswalks and matching

@query
def rewrite_keys(spark, d):
    resolved = resolve.resolve_references(table(spark, d, "lineitem_ids"), _LINE, _line_maps(spark, d), keep_source_id=False)
    return crosswalk.rewrite_keys(resolved, _LINE, table(spark, d, "supplier_key_xwalk")).select(
        "l_id", "order__key", "part__key", "supplier__key")


@query
def resolve_raw_refs(spark, d):
    spec = TableSpec("orders", "o_orderkey", refs=(Ref("cust_ref", ("customer",), "customer"),))
    return crosswalk.resolve_raw_refs(table(spark, d, "orders_raw"), spec, table(spark, d, "customer_xwalk"))


@query
def map_to_target_ids(spark, d):
    src = table(spark, d, "customer").select("c_name", "c_acctbal", "c_mktsegment")
    return crosswalk.map_to_target_ids(src, table(spark, d, "customer_numbered"), "c_name", "c_custkey",
                                       table(spark, d, "customer_key_xwalk"))


@query
def match_by_name(spark, d):
    return crosswalk.match_by_name(table(spark, d, "part"), table(spark, d, "part_tgt"), "p_name", "p_partkey", "p_partkey")


@query
def match_by_composite(spark, d):
    """Suppliers by (nation name, supplier name), nation names resolved on each side."""
    spec = STAR[3]

    def keyed(suppliers: DataFrame, nations: DataFrame) -> DataFrame:
        maps = resolve.id_maps({"nation": nations}, [STAR[1]])
        return resolve.resolve_references(suppliers, spec, maps)

    src = keyed(table(spark, d, "supplier"), table(spark, d, "nation"))
    tgt = keyed(table(spark, d, "supplier_tgt"), table(spark, d, "nation_tgt"))
    return crosswalk.match_by_composite(src, tgt, ["nation__key", "s_name"], "s_suppkey", "s_suppkey")


# Writing and undoing

def _sales_upsert(spark, d) -> DataFrame:
    return load.upsert(table(spark, d, "sales"), table(spark, d, "sales_batch"), "okey", "id")


@query
def upsert(spark, d):
    return load.current(_sales_upsert(spark, d))


@query
def upsert_trace(spark, d):
    rows = load.loaded_rows(_sales_upsert(spark, d), 1, "sales", "id", "okey")
    return rows.select("order", "table", "op", "source_id", "target_id", "source_key", "target_key",
                       F.col("prior.price").alias("prior_price"))


@query
def insert_ids(spark, d):
    target = table(spark, d, "sales")
    batch = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"),
                                             F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    return load.current(load.insert(target, batch, "id", ["priority", "o_orderkey"]))


@query
def delete_ids(spark, d):
    gone = table(spark, d, "sales").where("status = 'F'").select("id")
    kept, removed = load.delete_ids(table(spark, d, "sales"), gone, "id")
    return kept.withColumn("deleted", F.lit(False)).unionByName(removed.withColumn("deleted", F.lit(True))).select(
        "id", "okey", "deleted")


@query
def deactivate(spark, d):
    return load.deactivate(table(spark, d, "sales"), "active", "id")[0].select("id", "active")


@query
def reactivate(spark, d):
    """New rows that arrived inactive stay inactive."""
    sales = table(spark, d, "sales")
    off, ids = load.deactivate(sales, "active", "id")
    return load.reactivate(off, ids, "active", "id").select("id", "active")


@query
def two_batches(spark, d):
    """Lines of urgent orders are written before the others; each gets the next free ids."""
    lines = table(spark, d, "lineitem_ids").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    batch = lines.withColumn("_source_id", F.col("l_orderkey").cast("string"))
    target = table(spark, d, "sales").select("id", F.col("id").alias("l_orderkey"), F.lit(0.0).alias("quantity")).where("false")
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    put = lambda into, rows: load.insert(into, rows, "id", ["l_orderkey"])
    out = load.traced(target, load.in_two_batches(target, batch, "id", "l_orderkey", urgent, None, put), "id")
    return out.select("id", "l_orderkey", "quantity", F.col("_source_id").alias("source_id"))


@query
def id_xwalk(spark, d):
    rows = load.loaded_rows(_sales_upsert(spark, d), 1, "sales", "id", "okey")
    return crosswalk.id_xwalk(rows, "sales")


@query
def key_xwalk(spark, d):
    """A target that numbers keys itself: matched rows keep theirs, new rows get another one."""
    target = table(spark, d, "sales")
    src = table(spark, d, "sales_batch").withColumn("_source_key", F.col("okey"))
    batch = crosswalk.map_to_target_ids(src, target, "okey", "id").drop("op")
    written = load.upsert_by_id(target, batch, "id", ["_source_key"], "okey")
    return crosswalk.key_xwalk(load.loaded_rows(written, 1, "sales", "id", "okey"), "sales", "okey")


@query
def load_log(spark, d):
    return log.load_log(table(spark, d, "outcomes"))


@query
def load_summary(spark, d):
    return log.load_summary(log.load_log(table(spark, d, "outcomes")))


@query
def rollback_plan(spark, d):
    return log.rollback_plan(log.load_log(table(spark, d, "outcomes")))


@query
def loaded_ids(spark, d):
    rows = table(spark, d, "customer_keys").select(F.col("c_custkey").alias("id"), "c_key")
    again = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("c_key"),
                                               F.lit(True).alias("retried"))
    return log.loaded_ids(rows, "id", "c_key", again)


@query
def result_files(spark, d):
    path = new_path(spark, "results")
    checked = clean.classify_rejects(table(spark, d, "rejects"))
    ok = checked.where(F.col("error").isNull()).select("o_orderkey")
    write_results(ok, checked.where(F.col("error").isNotNull()).select("o_orderkey", "error"), "orders", path)
    return spark.read.parquet(path)


@query
def rollback(spark, d):
    """Upsert and undo: the target is what it was."""
    written = _sales_upsert(spark, d)
    loaded = load.loaded_rows(written, 1, "sales", "id", "okey")
    return log.undo_table(load.current(written), loaded, SALES)[0]


@query
def rollback_report(spark, d):
    """Some of the loaded rows are gone from the target by the time of the rollback."""
    written = _sales_upsert(spark, d)
    loaded = load.loaded_rows(written, 1, "sales", "id", "okey")
    return log.undo_table(load.current(written).where("status <> 'X' OR price < 400000"), loaded, SALES)[1]


@query
def rollback_by_key(spark, d):
    """The log knows keys only."""
    written = _sales_upsert(spark, d)
    loaded = load.loaded_rows(written, 1, "sales", "id", "okey").withColumn("target_id", F.lit(None).cast("string"))
    return log.undo_table(load.current(written), loaded, SALES)[0]


# Manifests, previews, whole runs

@query
def manifest(spark, d):
    env, tiers = star(spark, d), table_tiers(STAR)
    lines = [(manifest_entry("full", tiers[s.name][0], i + 1, f"tier-{tiers[s.name][0]}/{i + 1:02d}-{s.name}", s), env[s.name])
             for i, s in enumerate(load_order(STAR))]
    return log.load_plan(build_manifest(spark, lines))


@query
def plan(spark, d):
    specs = [s.with_(composite_key=("p_name", "p_brand")) if s.name == "part" else s.with_(resolve_only=s.name == "region")
             for s in STAR]
    return plans.plan(star(spark, d), specs)


@query
def export_load_roundtrip(spark, d):
    """Export everything, load it into an empty target with other ids, and compare."""
    env = star(spark, d)
    bundle = plans.export(env, STAR, new_path(spark, "bundle"))
    empty = {t: df.where("false") for t, df in env.items()}
    result = plans.load(empty, bundle, STAR)
    found = plans.compare(env, result.env, STAR).summary.select("table", "source", "target", "new", "modified", "deleted", "identical")
    # Tables without a key are compared by what they point to.
    out = [found]
    for spec in (STAR[5], STAR[6]):
        sides = []
        for side in (env, result.env):
            named = dict(side)
            names = resolve.id_maps(named, STAR)
            if spec.name == "lineitem":
                orders = side["orders"].select(F.col("o_orderkey").alias("id"), F.concat_ws("|", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("key"))
                # Orders of known customers; a customer without a name is marked.
                customers = side["customer"].select("c_custkey", F.coalesce(F.concat(F.lit("="), "c_name"), F.lit("-")).alias("name"))
                known = lookup.look_up(side["orders"], [lookup.Lookup(F.col("o_custkey"), customers, "_name")]).where("_name IS NOT NULL")
                orders = known.select(F.col("o_orderkey").alias("id"), F.concat_ws("|", F.expr("IF(_name LIKE '=%', substring(_name, 2), NULL)"),
                                                                                   F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("key"))
                names = {**names, "orders": orders}
            resolved = resolve.resolve_references(side[spec.name], spec, names)
            sides.append(resolved)
        cols = ["customer__key", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"] if spec.name == "orders" \
            else ["order__key", "supplier__key", "l_linenumber", "l_quantity"]
        counts = diff.fingerprint_totals(sides[0], sides[1], cols)
        out.append(counts.select(F.lit(spec.name).alias("table"), "source", "target", "new",
                                 F.lit(0).cast("bigint").alias("modified"), "deleted", "identical"))
    return reduce(DataFrame.union, out)


@query
def delta_roundtrip(spark, d):
    """Bring a later target up to date with a delta; only rows unknown to the source remain different."""
    specs = [CUSTOMER.with_(refs=()), ORDERS.with_(key="o_key", compare_ignore=("o_custkey",), refs=())]
    env = {"customer": table(spark, d, "customer"), "orders": _keyed(table(spark, d, "orders"))}
    target = {"customer": table(spark, d, "customer_tgt"), "orders": _keyed(table(spark, d, "orders_tgt"))}
    before = plans.compare(env, target, specs)
    bundle = plans.export_delta(env, before, specs, new_path(spark, "delta"))
    after = plans.compare(env, plans.load(target, bundle, specs).env, specs)
    return after.summary.select("table", "source", "target", "new", "modified", "deleted", "identical")


def _keyed(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_key", F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")))


@query
def bundle_csv(spark, d):
    """A bundle in CSV form: resolved references under dotted headers, read back by name."""
    env = {"customer": table(spark, d, "customer"), "orders": table(spark, d, "orders")}
    specs = [CUSTOMER, ORDERS.with_(key=None)]
    bundle = plans.export(env, specs, new_path(spark, "bundle"), fmt="csv")
    line = next(e for e, _ in bundle.entries if e[4] == "orders")
    df = read_table(spark, f"{bundle.path}/{line[3]}", "csv")
    return df.select("o_orderkey", F.col("`customer.c_name`").alias("customer_name"), "o_orderpriority")


@query
def load_rollback(spark, d):
    """A load over existing rows, taken back: rows and values are those from before."""
    specs = [ORDERS.with_(key="o_key", refs=())]
    env, target = {"orders": _keyed(table(spark, d, "orders"))}, {"orders": _keyed(table(spark, d, "orders_tgt"))}
    bundle = plans.export(env, specs, new_path(spark, "bundle"))
    result = plans.load(target, bundle, specs)
    back, _ = plans.rollback(result.env, result, specs)
    return back["orders"].select("o_orderkey", "o_key", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def load_rollback_flags(spark, d):
    """A load over rows with an active flag, saved, opened again and taken back: rows, values and flags are those from before."""
    spec = SALES.with_(active_col="active")
    env = {"sales": table(spark, d, "sales_batch").select(F.col("_source_id").cast("bigint").alias("id"), "okey", "status", "price")}
    result = plans.load({"sales": table(spark, d, "sales")}, plans.export(env, [spec], new_path(spark, "bundle")), [spec])
    again = plans.LoadResult.open(spark, result.save(new_path(spark, "load")))
    return plans.rollback(result.env, again, [spec])[0]["sales"]


@query
def load_unreadable(spark, d):
    """Rows whose text is no number are refused; the table beside them shows that nothing of them was written."""
    price = F.when(F.col("_source_id").cast("bigint") % 10 == 0, "n/a").otherwise(F.col("price").cast("string"))
    env = {"sales": table(spark, d, "sales_batch").select(F.col("_source_id").cast("bigint").alias("id"), "okey", "status", price.alias("price"))}
    result = plans.load({"sales": table(spark, d, "sales")}, plans.export(env, [SALES], new_path(spark, "bundle")), [SALES], on_error="continue")
    now = result.env["sales"].select("okey", "status", "price", F.lit(None).cast("string").alias("error"))
    return now.unionByName(result.rejected["sales"].select("okey", "error"), allowMissingColumns=True)


@query
def load_stopped(spark, d):
    """A load that breaks in its second table, opened from its journal and taken back: the first table as it was before, and as the load left it."""
    lines = TableSpec("lines", "l_id", refs=(Ref("l_orderkey", ("sales",), "sale"),))
    env = {"sales": table(spark, d, "sales_batch").select(F.col("_source_id").cast("bigint").alias("id"), "okey", "status", "price"),
           "lines": table(spark, d, "lineitem_ids").select("l_id", "l_orderkey", "l_quantity")}
    target = {"sales": table(spark, d, "sales"), "lines": env["lines"].where("false")}
    specs, journal = [SALES.with_(active_col=None), lines], new_path(spark, "journal")

    def breaks(df, spec, attempt):
        return df.withColumn("errors", F.expr("no_such_column")) if spec.name == "lines" else df

    try:
        plans.load(target, plans.export(env, specs, new_path(spark, "bundle")), specs, checker=breaks, journal=journal)
    except plans.LoadStopped:
        pass
    again = plans.LoadResult.recover(target, journal, specs)
    back = plans.rollback(again.env, again, specs)[0]["sales"]
    show = lambda df, when: df.select(F.lit(when).alias("state"), "id", "okey", "status", "price", "active")
    return show(again.env["sales"], "stopped").unionByName(show(back, "undone"))


@query
def load_counters(spark, d):
    """What the steps of a load counted while they wrote."""
    env = {"sales": table(spark, d, "sales_batch").select(F.col("_source_id").cast("bigint").alias("id"), "okey", "status", "price")}
    result = plans.load({"sales": table(spark, d, "sales")}, plans.export(env, [SALES], new_path(spark, "bundle")), [SALES])
    return result.counters.select("table", "counter", "n")


@query
def mixed_references(spark, d):
    """Customers that refer to suppliers or to other customers: in a new environment each still refers to the same row."""
    spec = TableSpec("customer", "c_custkey", "c_name", refs=(Ref("ref", ("supplier", "customer"), "party"),))
    specs = [TableSpec("supplier", "s_suppkey", "s_name"), spec]
    source = {"supplier": table(spark, d, "supplier").select("s_suppkey", "s_name"), "customer": table(spark, d, "customer_mixed")}
    empty = {t: df.where("false") for t, df in source.items()}
    env = plans.load(empty, plans.export(source, specs, new_path(spark, "bundle")), specs).env
    people = env["customer"].select(F.col("c_custkey").alias("ref"), F.col("c_name").alias("customer"))
    suppliers = env["supplier"].select(F.col("s_suppkey").alias("ref"), F.col("s_name").alias("supplier"))
    # Ids of the new environment may mean a row of either table; what a customer refers to is told by the source.
    kind = source["customer"].select(F.col("c_name").alias("name"), F.col("ref").alias("old"))
    known = kind.join(source["supplier"].select(F.col("s_suppkey").alias("old"), F.lit(True).alias("to_supplier")), "old", "left").drop("old")
    found = env["customer"].join(people, "ref", "left").join(suppliers, "ref", "left").join(known, F.col("c_name") == F.col("name"))
    return found.select("c_name", F.when(F.col("to_supplier"), F.col("supplier")).otherwise(F.col("customer")).alias("refers_to"))
