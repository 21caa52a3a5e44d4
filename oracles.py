"""The registered queries in SQL, for checking. Braces name tables as in :mod:`fixtures_sql`."""

from __future__ import annotations

from fixtures_sql import sql

# White space at both ends, as in tabsync.functions.text.trimmed.
_TRIM = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
_EMAIL = r"regexp_matches(coalesce({c}, ''), '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}$')"


def trim(c: str) -> str:
    return _TRIM.replace("{c}", c)


def email(c: str) -> str:
    return _EMAIL.replace("{c}", trim(c)).replace("{{", "{").replace("}}", "}")


def _orders_diff() -> str:
    return """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS k, s.o_orderkey AS sk, t.o_orderkey AS tk,
        CASE WHEN t.o_orderkey IS NULL THEN 'new' WHEN s.o_orderkey IS NULL THEN 'deleted'
             WHEN s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
               OR s.o_orderdate IS DISTINCT FROM t.o_orderdate OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority
             THEN 'modified' ELSE 'identical' END AS status
        FROM {orders} s FULL JOIN {orders_tgt} t ON s.o_orderkey = t.o_orderkey"""


def _customer_diff() -> str:
    return """SELECT CASE WHEN t.c_name IS NULL THEN 'new' WHEN s.c_name IS NULL THEN 'deleted'
             WHEN s.c_acctbal IS DISTINCT FROM t.c_acctbal OR s.c_mktsegment IS DISTINCT FROM t.c_mktsegment
             THEN 'modified' ELSE 'identical' END AS status
        FROM {customer} s FULL JOIN {customer_tgt} t ON s.c_name = t.c_name"""


def _event_counts() -> str:
    return """SELECT user_id, event_type, CAST(sum(s) AS BIGINT) AS source, CAST(sum(t) AS BIGINT) AS target,
        CAST(least(sum(s), sum(t)) AS BIGINT) AS identical, CAST(greatest(sum(s) - sum(t), 0) AS BIGINT) AS new,
        CAST(greatest(sum(t) - sum(s), 0) AS BIGINT) AS deleted
        FROM (SELECT user_id, event_type, 1 AS s, 0 AS t FROM {events}
              UNION ALL SELECT user_id, event_type, 0, 1 FROM {events_tgt}) GROUP BY ALL"""


def _summary(table: str, strategy: str, rows: str) -> str:
    return f"""SELECT '{table}' AS "table", '{strategy}' AS strategy,
        count(*) FILTER (status <> 'deleted') AS source, count(*) FILTER (status <> 'new') AS target,
        count(*) FILTER (status = 'new') AS new, count(*) FILTER (status = 'modified') AS modified,
        count(*) FILTER (status = 'deleted') AS deleted, count(*) FILTER (status = 'identical') AS identical,
        CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS blank_keys FROM ({rows})"""


_LAST = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, " \
        "l_tax DESC, l_returnflag DESC, l_linestatus DESC"

_DOWN = """n AS (SELECT n_nationkey AS id FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
    c AS (SELECT c_custkey AS id FROM {customer} WHERE c_nationkey IN (SELECT id FROM n)),
    s AS (SELECT s_suppkey AS id FROM {supplier} WHERE s_nationkey IN (SELECT id FROM n)),
    o AS (SELECT o_orderkey AS id FROM {orders} WHERE o_custkey IN (SELECT id FROM c)),
    l AS (SELECT DISTINCT l_id AS id FROM {lineitem_ids}
          WHERE l_orderkey IN (SELECT id FROM o) OR l_suppkey IN (SELECT id FROM s))"""

_SALES_NEW = """SELECT b.* FROM {sales_batch} b WHERE b.okey NOT IN (SELECT okey FROM {sales})"""
_TOP = "(SELECT max(id) FROM {sales})"

_RETRY = """r AS (SELECT *, coalesce(error, '') LIKE '%UNABLE_TO_LOCK_ROW%'
                        OR coalesce(error, '') LIKE '%Too many retries of batch save%' AS retryable FROM {rejects})"""

_TURN_LAST = "SELECT conv_id, max(turn) AS last_turn FROM {turns} GROUP BY conv_id"


def _numbered() -> str:
    return """held AS (SELECT c_name, max(c_custkey) AS id FROM {customer_numbered} GROUP BY c_name)"""


ORACLES = {
    "diff_by_key": f"""SELECT 'orders' AS "table", status, 'key' AS strategy, CAST(k AS STRING) AS key,
        CAST(sk AS STRING) AS source_id, CAST(tk AS STRING) AS target_id FROM ({_orders_diff()})""",

    "diff_documents": """SELECT 'documents' AS "table", CASE WHEN t.doc_id IS NULL THEN 'new' WHEN s.doc_id IS NULL THEN 'deleted'
            WHEN s.text IS DISTINCT FROM t.text OR coalesce(s.lang, '') <> coalesce(t.lang, '') OR s.source IS DISTINCT FROM t.source
              OR s.n_chars IS DISTINCT FROM t.n_chars THEN 'modified' ELSE 'identical' END AS status, 'key' AS strategy,
            CAST(coalesce(s.doc_id, t.doc_id) AS STRING) AS key, CAST(s.doc_id AS STRING) AS source_id, CAST(t.doc_id AS STRING) AS target_id
        FROM {documents} s FULL JOIN {documents_tgt} t ON s.doc_id = t.doc_id""",

    "diff_changes": """WITH j AS (SELECT CAST(s.o_orderkey AS STRING) AS key, s.o_orderstatus AS s1, t.o_orderstatus AS t1,
            s.o_totalprice AS s2, t.o_totalprice AS t2 FROM {orders_money} s JOIN {orders_tgt_money} t USING (o_orderkey))
        SELECT 'orders' AS "table", key, 'o_orderstatus' AS field, s1 AS source_value, t1 AS target_value
        FROM j WHERE coalesce(s1, '') <> coalesce(t1, '')
        UNION ALL SELECT 'orders', key, 'o_totalprice', CAST(s2 AS STRING), CAST(t2 AS STRING) FROM j WHERE s2 IS DISTINCT FROM t2""",

    "diff_summary": f"""WITH lines AS ({_summary('orders', 'key', _orders_diff())}
        UNION ALL {_summary('customer', 'key', _customer_diff())}
        UNION ALL SELECT 'events', 'fingerprint', sum(source), sum(target), sum(new), 0, sum(deleted), sum(identical), 0, 0
        FROM ({_event_counts()}))
        SELECT "table", strategy, CAST(source AS BIGINT) AS source, CAST(target AS BIGINT) AS target, CAST(new AS BIGINT) AS new,
            CAST(modified AS BIGINT) AS modified, CAST(deleted AS BIGINT) AS deleted, CAST(identical AS BIGINT) AS identical,
            CAST(duplicate_keys AS BIGINT) AS duplicate_keys, CAST(blank_keys AS BIGINT) AS blank_keys FROM lines
        UNION ALL SELECT 'TOTAL', NULL, CAST(sum(source) AS BIGINT), CAST(sum(target) AS BIGINT), CAST(sum(new) AS BIGINT),
            CAST(sum(modified) AS BIGINT), CAST(sum(deleted) AS BIGINT), CAST(sum(identical) AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM lines""",

    "diff_duplicate_keys": """WITH c AS (SELECT count(*) FILTER (l_key IS NOT NULL AND l_key <> '') AS usable,
            count(DISTINCT l_key) FILTER (l_key <> '') AS keys, count(*) FILTER (l_key IS NULL OR l_key = '') AS blanks FROM {lineitem_keys})
        SELECT 'lineitem' AS "table", 'key' AS strategy, keys AS source, keys AS target, CAST(0 AS BIGINT) AS new,
            CAST(0 AS BIGINT) AS modified, CAST(0 AS BIGINT) AS deleted, keys AS identical,
            CAST(2 * (usable - keys) AS BIGINT) AS duplicate_keys, CAST(2 * blanks AS BIGINT) AS blank_keys FROM c""",

    "diff_fingerprint_counts": _event_counts(),
    "diff_fingerprint_summary": f"""SELECT CAST(sum(source) AS BIGINT) AS source, CAST(sum(target) AS BIGINT) AS target,
        CAST(sum(identical) AS BIGINT) AS identical, CAST(sum(new) AS BIGINT) AS new, CAST(sum(deleted) AS BIGINT) AS deleted
        FROM ({_event_counts()})""",
    "diff_fingerprint_rows": """WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY substr(md5(CAST(event_id AS STRING)), 1, 4), event_id) AS rn FROM {events}),
        t AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY substr(md5(CAST(event_id AS STRING)), 1, 4), event_id) AS rn FROM {events_tgt})
        SELECT CASE WHEN t.event_id IS NULL THEN 'new' WHEN s.event_id IS NULL THEN 'deleted' ELSE 'identical' END AS status,
            CAST(s.event_id AS STRING) AS source_id, CAST(t.event_id AS STRING) AS target_id
        FROM s FULL JOIN t ON s.user_id = t.user_id AND s.event_type = t.event_type AND s.rn = t.rn""",
    "surplus": f"""SELECT user_id, event_type, CASE WHEN source > target THEN 'new' ELSE 'deleted' END AS status,
        abs(source - target) AS copies FROM ({_event_counts()}) WHERE source <> target""",
    "diff_report_summary": f"""SELECT * FROM ({_summary('orders', 'key', _orders_diff())}) UNION ALL SELECT * FROM ({_summary('customer', 'key', _customer_diff())})""",
    "diff_names": """SELECT CAST(coalesce(s.c_custkey, t.c_custkey) AS STRING) AS key, coalesce(s.c_name, t.c_name) AS name,
            CASE WHEN t.c_custkey IS NULL THEN 'new' WHEN s.c_custkey IS NULL THEN 'deleted'
                 WHEN s.c_acctbal IS DISTINCT FROM t.c_acctbal OR s.c_name <> t.c_name THEN 'modified' ELSE 'identical' END AS status
        FROM {customer} s FULL JOIN {customer_tgt} t ON s.c_custkey = t.c_custkey""",
    "order_columns": """SELECT o_orderkey, 0 AS place, 'o_orderkey=' || CAST(o_orderkey AS STRING) AS cell FROM {orders_money}
        UNION ALL SELECT o_orderkey, 1, 'o_custkey=' || CAST(o_custkey AS STRING) FROM {orders_money}
        UNION ALL SELECT o_orderkey, 2, 'o_orderpriority=' || o_orderpriority FROM {orders_money}
        UNION ALL SELECT o_orderkey, 3, 'o_orderstatus=' || o_orderstatus FROM {orders_money}
        UNION ALL SELECT o_orderkey, 4, 'o_totalprice=' || CAST(o_totalprice AS STRING) FROM {orders_money}""",
    "extract_delta": f"""SELECT * FROM {{orders}}
        WHERE o_orderkey IN (SELECT sk FROM ({_orders_diff()}) WHERE status IN ('new', 'modified'))""",
    "diff_report_files": f"""SELECT 'orders' AS "table", status, 'key' AS strategy, CAST(k AS STRING) AS key,
        CAST(sk AS STRING) AS source_id, CAST(tk AS STRING) AS target_id FROM ({_orders_diff()}) WHERE status <> 'identical'""",

    "dedupe_keep_last": f"""WITH x AS (SELECT *, coalesce({trim('l_key')}, '') AS k FROM {{lineitem_keys}}),
        r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {_LAST}) AS rn FROM x)
        SELECT l_key, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM r WHERE k = '' OR rn = 1""",
    "duplicates_removed": f"""SELECT CAST(count(*) - count(DISTINCT k) AS BIGINT) AS duplicates_removed
        FROM (SELECT {trim('l_key')} AS k FROM {{lineitem_keys}}) WHERE coalesce(k, '') <> ''""",
    "split_by_key": f"""SELECT c_custkey, CASE WHEN coalesce({trim('c_key')}, '') <> '' THEN c_key END AS c_key, c_nationkey, c_acctbal,
        c_mktsegment, CASE WHEN coalesce({trim('c_key')}, '') <> '' THEN 'upsert' ELSE 'insert' END AS operation FROM {{customer_keys}}""",
    "backfill_key": """SELECT c_custkey, coalesce(c_key, 'CUST-' || substr(CAST(c_custkey AS STRING), 1, 15)) AS c_key FROM {customer_keys}""",
    "classify_rejects": f"WITH {_RETRY} SELECT o_orderkey, o_custkey, error, retryable FROM r",
    "retry_rejects": f"""WITH {_RETRY},
        one AS (SELECT *, o_custkey % 2 = 0 AS ok1, o_custkey % 5 = 0 AS hard FROM r WHERE retryable),
        two AS (SELECT *, o_custkey % 3 = 0 AS ok2 FROM one WHERE NOT ok1 AND NOT hard)
        SELECT o_orderkey, o_custkey, error, 'failed' AS outcome FROM r WHERE NOT retryable
        UNION ALL SELECT o_orderkey, o_custkey, NULL, 'recovered' FROM one WHERE ok1
        UNION ALL SELECT o_orderkey, o_custkey, 'FIELD_INTEGRITY_EXCEPTION', 'failed' FROM one WHERE NOT ok1 AND hard
        UNION ALL SELECT o_orderkey, o_custkey, NULL, 'recovered' FROM two WHERE ok2
        UNION ALL SELECT o_orderkey, o_custkey, 'UNABLE_TO_LOCK_ROW', 'failed' FROM two WHERE NOT ok2""",
    "route_by_membership": """WITH m AS (SELECT s_suppkey AS k FROM {supplier_tgt} WHERE s_nationkey % 20 = 13),
        all_ids AS (SELECT k FROM m UNION SELECT s_suppkey FROM {supplier} WHERE s_suppkey * 10 + 3 IN (SELECT k FROM m))
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
            CASE WHEN l_suppkey IN (SELECT k FROM all_ids) THEN 'first' ELSE 'rest' END AS batch FROM {lineitem}""",

    "resolve_refs_orders": """SELECT o_orderkey, CASE WHEN c_name IS NULL THEN o_custkey END AS o_custkey, o_orderstatus,
        c_name AS customer__key, o_orderkey AS _source_id FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey""",
    "resolve_refs_lineitem": """SELECT l_id, CAST(NULL AS BIGINT) AS l_orderkey,
        CASE WHEN p_size <= 25 THEN NULL ELSE l_partkey END AS l_partkey, CAST(NULL AS BIGINT) AS l_suppkey, l_linenumber, l_quantity,
        o_key AS order__key, CASE WHEN p_size <= 25 THEN p_key END AS part__key, s_name AS supplier__key
        FROM {lineitem_ids} JOIN {order_keys} ON l_orderkey = o_orderkey JOIN {part_keys} ON l_partkey = p_partkey
        JOIN {supplier} ON l_suppkey = s_suppkey""",
    "resolve_polymorphic": """SELECT event_id, CASE WHEN coalesce(c.party_key, s.party_key) IS NULL THEN e.party_id END AS party_id,
        coalesce(c.party_key, s.party_key) AS party__key FROM {event_party} e
        LEFT JOIN {customer_party} c ON e.party_id = c.party_id LEFT JOIN {supplier_party} s ON e.party_id = s.party_id""",
    "unresolved_refs": """SELECT 'o_custkey' AS field, CAST(o_custkey AS STRING) AS value, count(*) AS n FROM {orders}
        JOIN {customer} ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' GROUP BY o_custkey""",
    "self_ref_pass2": """SELECT a.turn_key, b.turn_key AS reply__key FROM {turns} a JOIN {turns} b ON a.reply_to = b.id""",
    "bind_parents": """SELECT o.o_orderkey, c.c_custkey * 10 + 3 AS o_custkey,
        CASE WHEN coalesce(trim(o.customer__key), '') <> '' AND c.c_custkey IS NULL THEN 'UNRESOLVED_REFERENCE:o_custkey' ELSE '' END AS unbound
        FROM {orders_check} o LEFT JOIN {customer} c ON o.customer__key = 'C-' || CAST(c.c_custkey AS STRING) AND c.c_custkey % 7 <> 0""",

    "record_tiers": "SELECT id AS node, CAST(turn AS INTEGER) AS tier, FALSE AS in_cycle, FALSE AS below_cycle FROM {turns}",
    "record_tiers_parallel_edges": "SELECT DISTINCT node, CAST(expected AS INTEGER) AS tier, FALSE AS in_cycle FROM {row_nodes}",
    "record_tiers_cycle": f"""WITH m AS ({_TURN_LAST}),
        x AS (SELECT id, turn, t.conv_id % 10 IN (0, 1) AND last_turn > 0 AS stuck, t.conv_id % 10 = 1 AS short
              FROM {{turns}} t JOIN m USING (conv_id))
        SELECT id AS node, CAST(CASE WHEN stuck THEN (SELECT max(turn) + 1 FROM x WHERE NOT stuck) ELSE turn END AS INTEGER) AS tier,
            stuck AS in_cycle, stuck AND short AND turn > 1 AS below_cycle FROM x""",
    "table_tiers_report": """WITH f(tier, "table", keys, "references", self_references, gap) AS (VALUES
            (0, 'benchmark', NULL, 0, 0, NULL), (0, 'conversations', NULL, 0, 1, 'Has self reference(s) but no key'),
            (0, 'documents', NULL, 0, 0, 'Referenced by 1 table(s) but has no key'), (0, 'embeddings', NULL, 0, 0, NULL),
            (0, 'events', NULL, 0, 0, NULL), (0, 'pages', 'url', 0, 0, NULL),
            (0, 'part', NULL, 0, 0, 'Referenced by 1 table(s) but has no key'), (0, 'region', 'r_name', 0, 0, NULL),
            (1, 'labels', NULL, 1, 0, NULL), (1, 'nation', 'n_name', 1, 0, NULL), (2, 'customer', 'c_name', 1, 0, NULL),
            (2, 'supplier', 's_name', 1, 0, NULL), (3, 'orders', NULL, 1, 0, 'Referenced by 1 table(s) but has no key'),
            (4, 'lineitem', NULL, 3, 0, NULL)),
        n AS (SELECT 'benchmark' AS "table", count(*) AS records FROM {benchmark} UNION ALL SELECT 'conversations', count(*) FROM {conversations}
            UNION ALL SELECT 'documents', count(*) FROM {documents} UNION ALL SELECT 'embeddings', count(*) FROM {embeddings}
            UNION ALL SELECT 'events', count(*) FROM {events} UNION ALL SELECT 'pages', count(*) FROM {pages}
            UNION ALL SELECT 'part', count(*) FROM {part} UNION ALL SELECT 'region', count(*) FROM {region}
            UNION ALL SELECT 'labels', count(*) FROM {labels} UNION ALL SELECT 'nation', count(*) FROM {nation}
            UNION ALL SELECT 'customer', count(*) FROM {customer} UNION ALL SELECT 'supplier', count(*) FROM {supplier}
            UNION ALL SELECT 'orders', count(*) FROM {orders} UNION ALL SELECT 'lineitem', count(*) FROM {lineitem})
        SELECT CAST(tier AS INTEGER) AS tier, "table", records, keys, CAST("references" AS INTEGER) AS "references",
            CAST(self_references AS INTEGER) AS self_references, FALSE AS in_cycle, gap FROM f JOIN n USING ("table")""",
    "fk_edges": """WITH e(child, parent, field, relationship) AS (VALUES ('nation', 'region', 'n_regionkey', 'region'),
            ('customer', 'nation', 'c_nationkey', 'nation'), ('supplier', 'nation', 's_nationkey', 'nation'),
            ('orders', 'customer', 'o_custkey', 'customer'), ('lineitem', 'orders', 'l_orderkey', 'order'),
            ('lineitem', 'part', 'l_partkey', 'part'), ('lineitem', 'supplier', 'l_suppkey', 'supplier'),
            ('labels', 'documents', 'doc_id', 'document')),
        n AS (SELECT 'documents' AS t, count(*) AS r FROM {documents} UNION ALL SELECT 'part', count(*) FROM {part}
            UNION ALL SELECT 'region', count(*) FROM {region} UNION ALL SELECT 'labels', count(*) FROM {labels}
            UNION ALL SELECT 'nation', count(*) FROM {nation} UNION ALL SELECT 'customer', count(*) FROM {customer}
            UNION ALL SELECT 'supplier', count(*) FROM {supplier} UNION ALL SELECT 'orders', count(*) FROM {orders}
            UNION ALL SELECT 'lineitem', count(*) FROM {lineitem})
        SELECT child, parent, field, relationship, a.r AS child_rows, b.r AS parent_rows
        FROM e JOIN n a ON e.child = a.t JOIN n b ON e.parent = b.t""",
    "discover_tables": """SELECT 'orders' AS "table", count(*) AS records, CAST(6 AS BIGINT) AS columns FROM {orders}
        UNION ALL SELECT 'customer', count(*), 5 FROM {customer} UNION ALL SELECT 'lineitem', count(*), 6 FROM {lineitem}
        UNION ALL SELECT 'labels', count(*), 3 FROM {labels} UNION ALL SELECT 'conversations', count(*), 5 FROM {conversations}""",
    "row_counts": """SELECT 'orders' AS "table", count(*) AS records FROM {orders} WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'lineitem', count(*) FROM {lineitem} WHERE l_quantity > 25
        UNION ALL SELECT 'customer', count(*) FROM {customer} UNION ALL SELECT 'missing', -1""",
    "key_gaps": """WITH k AS (SELECT c_custkey AS node FROM {customer_keys} WHERE coalesce(c_key, '') = ''),
        i AS (SELECT o_custkey AS node, count(DISTINCT o_orderkey) AS children FROM {orders} GROUP BY o_custkey)
        SELECT node, children, 'referenced but has no key' AS reason FROM i WHERE node IN (SELECT node FROM k)
        UNION ALL SELECT node, 0, 'refers to itself but has no key' FROM k WHERE node % 2 = 1 AND node NOT IN (SELECT node FROM i)""",
    "key_quality": """WITH v AS (SELECT 'c_key' AS "column", c_key AS value FROM {customer_keys}
            UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM {customer_keys}
            UNION ALL SELECT 'c_custkey', CAST(c_custkey AS STRING) FROM {customer_keys})
        SELECT "column", count(*) AS records, count(*) FILTER (value IS NULL) AS null_keys, count(*) FILTER (value = '') AS blank_keys,
            count(DISTINCT value) FILTER (value <> '') AS distinct_keys,
            CAST(count(*) FILTER (value <> '') - count(DISTINCT value) FILTER (value <> '') AS BIGINT) AS duplicate_rows FROM v GROUP BY 1""",
    "rank_key_candidates": """WITH v AS (SELECT 'l_key' AS "column", 5 AS preference, l_key AS value FROM {lineitem_keys}
            UNION ALL SELECT 'l_orderkey', 6, CAST(l_orderkey AS STRING) FROM {lineitem_keys}
            UNION ALL SELECT 'l_partkey', 0, CAST(l_partkey AS STRING) FROM {lineitem_keys}
            UNION ALL SELECT 'l_suppkey', 8, CAST(l_suppkey AS STRING) FROM {lineitem_keys})
        SELECT "column", CAST(count(*) - count(DISTINCT value) FILTER (value <> '') AS BIGINT) AS defects,
            CAST(max(preference) AS INTEGER) AS preference FROM v GROUP BY 1""",

    "subset_down": f"""WITH {_DOWN} SELECT 'region' AS "table", CAST(r_regionkey AS STRING) AS id FROM {{region}} WHERE r_name = 'ASIA'
        UNION ALL SELECT 'nation', CAST(id AS STRING) FROM n UNION ALL SELECT 'customer', CAST(id AS STRING) FROM c
        UNION ALL SELECT 'supplier', CAST(id AS STRING) FROM s UNION ALL SELECT 'orders', CAST(id AS STRING) FROM o
        UNION ALL SELECT 'lineitem', id FROM l""",
    "subset_cycle": """WITH RECURSIVE e AS (SELECT DISTINCT child, parent FROM {turn_edges_cycle}),
        down(id) AS (SELECT id FROM {turns} WHERE turn = 1 AND conv_id % 5 = 0 UNION SELECT child FROM e JOIN down ON parent = id),
        up(id) AS (SELECT id FROM down UNION SELECT parent FROM e JOIN up ON child = id)
        SELECT 'turns' AS "table", CAST(id AS STRING) AS id FROM up""",
    "subset_full": f"""WITH {_DOWN}, lr AS (SELECT * FROM {{lineitem_ids}} WHERE l_id IN (SELECT id FROM l)),
        o2 AS (SELECT id FROM o UNION SELECT l_orderkey FROM lr), s2 AS (SELECT id FROM s UNION SELECT l_suppkey FROM lr),
        p2 AS (SELECT DISTINCT l_partkey AS id FROM lr),
        c2 AS (SELECT id FROM c UNION SELECT o_custkey FROM {{orders}} WHERE o_orderkey IN (SELECT id FROM o2)),
        n2 AS (SELECT id FROM n UNION SELECT c_nationkey FROM {{customer}} WHERE c_custkey IN (SELECT id FROM c2)
               UNION SELECT s_nationkey FROM {{supplier}} WHERE s_suppkey IN (SELECT id FROM s2)),
        r2 AS (SELECT r_regionkey AS id FROM {{region}} WHERE r_name = 'ASIA'
               UNION SELECT n_regionkey FROM {{nation}} WHERE n_nationkey IN (SELECT id FROM n2))
        SELECT 'region' AS "table", CAST(id AS STRING) AS id FROM r2 UNION ALL SELECT 'nation', CAST(id AS STRING) FROM n2
        UNION ALL SELECT 'customer', CAST(id AS STRING) FROM c2 UNION ALL SELECT 'supplier', CAST(id AS STRING) FROM s2
        UNION ALL SELECT 'part', CAST(id AS STRING) FROM p2 UNION ALL SELECT 'orders', CAST(id AS STRING) FROM o2
        UNION ALL SELECT 'lineitem', id FROM l""",
    "subset_up_from_orders": """WITH o AS (SELECT * FROM {orders} WHERE o_orderpriority = '1-URGENT'),
        l AS (SELECT * FROM {lineitem_ids} WHERE l_orderkey IN (SELECT o_orderkey FROM o)),
        s AS (SELECT * FROM {supplier} WHERE s_suppkey IN (SELECT l_suppkey FROM l)),
        c AS (SELECT * FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM o)),
        n AS (SELECT * FROM {nation} WHERE n_nationkey IN (SELECT s_nationkey FROM s) OR n_nationkey IN (SELECT c_nationkey FROM c))
        SELECT 'region' AS "table", count(*) AS "rows" FROM {region} WHERE r_regionkey IN (SELECT n_regionkey FROM n)
        UNION ALL SELECT 'nation', count(*) FROM n UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'supplier', count(*) FROM s
        UNION ALL SELECT 'part', count(*) FROM {part} WHERE p_partkey IN (SELECT l_partkey FROM l)
        UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM l""",
    "subset_portable": """WITH n AS (SELECT n_nationkey AS id, n_name AS key FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
        c AS (SELECT c_name AS key FROM {customer} WHERE c_nationkey IN (SELECT id FROM n)),
        s AS (SELECT s_name AS key FROM {supplier} WHERE s_nationkey IN (SELECT id FROM n))
        SELECT 'source' AS side, 'region' AS "table", r_name AS key FROM {region} WHERE r_name = 'ASIA'
        UNION ALL SELECT 'source', 'nation', key FROM n UNION ALL SELECT 'source', 'customer', key FROM c
        UNION ALL SELECT 'source', 'supplier', key FROM s
        UNION ALL SELECT 'target', 'region', r_name FROM {region} WHERE r_name = 'ASIA'
        UNION ALL SELECT 'target', 'nation', n_name FROM {nation_tgt} WHERE n_name IN (SELECT key FROM n)
        UNION ALL SELECT 'target', 'customer', c_name FROM {customer_tgt} WHERE c_name IN (SELECT key FROM c)
        UNION ALL SELECT 'target', 'supplier', s_name FROM {supplier_tgt} WHERE s_name IN (SELECT key FROM s)""",
    "path_filter": """SELECT l_id, l_orderkey, l_quantity FROM {lineitem_ids} JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {customer} ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "in_subquery_filter": """SELECT o_orderkey, o_custkey FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 5000)""",
    "in_list": """SELECT o_orderkey, o_orderpriority FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM', 'it''s none')""",

    "scan_spec": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag
        FROM {lineitem} WHERE l_quantity > 30 AND l_returnflag = 'R'""",
    "merge_column_groups": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice + 1 WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice,
        o_orderstatus FROM {orders}""",
    "assign_batches": """SELECT o_orderkey, o_orderpriority,
        CAST((row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1) // 1000 AS BIGINT) AS batch_no FROM {orders}""",
    "csv_roundtrip": """SELECT CAST(doc_id AS STRING) AS doc_id, text, lang, CASE WHEN n_chars > 500 THEN 'TRUE' ELSE 'FALSE' END AS long FROM {documents}""",
    "csv_untidy": """SELECT CAST(doc_id AS STRING) AS doc_id,
        NULLIF(CASE doc_id % 5 WHEN 1 THEN lang WHEN 3 THEN NULL ELSE text END, '') AS text,
        NULLIF(CASE doc_id % 5 WHEN 0 THEN 'a 5" pipe' WHEN 1 THEN NULL WHEN 2 THEN lang WHEN 3 THEN 'b "" c' ELSE text END, '') AS last
        FROM {documents} WHERE text IS NOT NULL""",

    "email_columns": f"""WITH v AS (SELECT 'c_name' AS "column", 'pattern' AS reason, c_name AS value FROM {{customer_mail}}
            UNION ALL SELECT 'contact_email', 'name', contact_email FROM {{customer_mail}}
            UNION ALL SELECT 'login', 'pattern', login FROM {{customer_mail}} UNION ALL SELECT 'remark', 'pattern', remark FROM {{customer_mail}}),
        c AS (SELECT "column", reason, count(*) FILTER (coalesce({trim('value')}, '') <> '') AS non_blank,
            count(*) FILTER ({email('value')}) AS emails FROM v GROUP BY 1, 2)
        SELECT *, reason <> 'pattern' OR 2 * emails > non_blank AS selected FROM c""",
    "mask_emails": f"""SELECT c_custkey, c_name,
        CASE WHEN {email('contact_email')} AND NOT {trim('contact_email')} LIKE '%.invalid' THEN {trim('contact_email')} || '.invalid' ELSE contact_email END AS contact_email,
        CASE WHEN {email('login')} AND NOT {trim('login')} LIKE '%.invalid' THEN {trim('login')} || '.invalid' ELSE login END AS login, remark
        FROM {{customer_mail}}""",
    "mask_counters": f"""SELECT 'contact_email' AS "column", count(*) AS masked FROM {{customer_mail}}
        WHERE {email('contact_email')} AND NOT {trim('contact_email')} LIKE '%.invalid'
        UNION ALL SELECT 'login', count(*) FROM {{customer_mail}} WHERE {email('login')}""",
    "defer_values": """SELECT o_orderkey, rule_key, CASE WHEN conditions = 'Custom' AND rule_key <> '' THEN 'All' ELSE conditions END AS conditions,
        CASE WHEN conditions = 'Custom' AND rule_key <> '' THEN NULL ELSE advanced END AS advanced FROM {rules}""",
    "deferred_values": """SELECT 'rules' AS "table", rule_key AS key, 'conditions' AS "column", conditions AS value FROM {rules}
        WHERE conditions = 'Custom' AND rule_key <> ''
        UNION ALL SELECT 'rules', rule_key, 'advanced', advanced FROM {rules} WHERE conditions = 'Custom' AND rule_key <> ''""",
    "restore_deferred": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 AND rule_key <> '' THEN 'T-' || CAST(o_orderkey AS STRING) ELSE rule_key END AS rule_key,
        conditions, advanced FROM {rules}""",
    "strip_columns": """SELECT o_orderkey, o_orderstatus, 'EUR' AS CurrencyIsoCode, 'C' || CAST(o_custkey AS STRING) AS customer__key,
        o_custkey AS agent, ' ' AS agent__key FROM {orders}""",
    "drop_listed": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM {orders}",
    "fixups": r"""SELECT doc_id, regexp_replace(text, '[\r\n]+', ' ', 'g') AS text, substr(source, 1, 4) AS source, 'FALSE' AS reviewed FROM {documents}""",
    "check_rows": """WITH d AS (SELECT o_key FROM {orders_check} WHERE o_key IS NOT NULL GROUP BY o_key HAVING count(*) > 1)
        SELECT o_orderkey, concat_ws(';', CASE WHEN length(o_orderpriority) > 8 THEN 'STRING_TOO_LONG:o_orderpriority' END,
            CASE WHEN trim(o_orderstatus) = '' THEN 'REQUIRED_FIELD_MISSING:o_orderstatus' END,
            CASE WHEN customer__key IS NULL THEN 'UNRESOLVED_REFERENCE:o_custkey' END,
            CASE WHEN o_key IN (SELECT o_key FROM d) THEN 'DUPLICATE_VALUE:o_key' END,
            CASE WHEN o_key IN (SELECT o_key FROM {taken_keys}) THEN 'KEY_EXISTS:o_key' END) AS errors FROM {orders_check}""",

    "rewrite_keys": """SELECT l_id, o_key AS order__key, CASE WHEN p_size <= 25 THEN p_key END AS part__key, coalesce(target_key, s_name) AS supplier__key
        FROM {lineitem_ids} JOIN {order_keys} ON l_orderkey = o_orderkey JOIN {part_keys} ON l_partkey = p_partkey
        JOIN {supplier} ON l_suppkey = s_suppkey LEFT JOIN {supplier_key_xwalk} ON s_name = source_key""",
    "resolve_raw_refs": """SELECT o_orderkey, CASE WHEN cust_ref LIKE 'ext-%' OR coalesce(trim(customer__key), '') <> '' THEN cust_ref
        ELSE target_id END AS cust_ref, customer__key FROM {orders_raw} LEFT JOIN {customer_xwalk} ON cust_ref = source_id""",
    "map_to_target_ids": f"""WITH {_numbered()} SELECT coalesce(a.id, b.id) AS c_custkey, c.c_acctbal, c.c_mktsegment,
        CASE WHEN coalesce(a.id, b.id) IS NULL THEN 'insert' ELSE 'update' END AS op FROM {{customer}} c LEFT JOIN held a ON c.c_name = a.c_name
        LEFT JOIN {{customer_key_xwalk}} x ON c.c_name = x.source_key LEFT JOIN held b ON x.target_key = b.c_name""",
    "match_by_name": """SELECT CAST(p.p_partkey AS STRING) AS source_id, p.p_name AS name, CAST(t.id AS STRING) AS target_id FROM {part} p
        LEFT JOIN (SELECT p_name, max(p_partkey) AS id FROM {part_tgt} GROUP BY p_name) t ON p.p_name = t.p_name""",
    "match_by_composite": """SELECT CAST(s.s_suppkey AS STRING) AS source_id, n.n_name AS nation__key, s.s_name, CAST(t.s_suppkey AS STRING) AS target_id
        FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
        LEFT JOIN (SELECT s_suppkey, s_name, n_name FROM {supplier_tgt} a JOIN {nation_tgt} b ON a.s_nationkey = b.n_nationkey) t
        ON s.s_name = t.s_name AND n.n_name = t.n_name""",

    "upsert": f"""SELECT s.id, s.okey, coalesce(b.status, s.status) AS status, coalesce(b.price, s.price) AS price, s.priority, s.active
        FROM {{sales}} s LEFT JOIN {{sales_batch}} b ON s.okey = b.okey
        UNION ALL SELECT {_TOP} + row_number() OVER (ORDER BY okey), okey, status, price, NULL, NULL FROM ({_SALES_NEW})""",
    "upsert_trace": f"""SELECT CAST(1 AS INTEGER) AS "order", 'sales' AS "table", 'update' AS op, b._source_id AS source_id, CAST(s.id AS STRING) AS target_id,
            b.okey AS source_key, s.okey AS target_key, s.price AS prior_price FROM {{sales}} s JOIN {{sales_batch}} b ON s.okey = b.okey
        UNION ALL SELECT 1, 'sales', 'insert', _source_id, CAST({_TOP} + row_number() OVER (ORDER BY okey) AS STRING), okey, okey, NULL FROM ({_SALES_NEW})""",
    "insert_ids": f"""SELECT {_TOP} + row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS id, CAST(NULL AS STRING) AS okey, o_orderstatus AS status,
        o_totalprice AS price, o_orderpriority AS priority, CAST(NULL AS BOOLEAN) AS active FROM {{orders}}""",
    "delete_ids": "SELECT id, okey, status = 'F' AS deleted FROM {sales}",
    "deactivate": "SELECT id, FALSE AS active FROM {sales}",
    "reactivate": "SELECT id, active FROM {sales}",
    "two_batches": """WITH l AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM {lineitem} GROUP BY 1)
        SELECT row_number() OVER (ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END, l_orderkey) AS id, l_orderkey,
            quantity, CAST(l_orderkey AS STRING) AS source_id FROM l JOIN {orders} ON l_orderkey = o_orderkey""",
    "id_xwalk": f"""SELECT 'sales' AS "table", b._source_id AS source_id, CAST(s.id AS STRING) AS target_id FROM {{sales}} s JOIN {{sales_batch}} b ON s.okey = b.okey
        UNION ALL SELECT 'sales', _source_id, CAST({_TOP} + row_number() OVER (ORDER BY okey) AS STRING) FROM ({_SALES_NEW})""",
    "key_xwalk": f"""SELECT 'sales' AS "table", 'okey' AS key_field, okey AS source_key,
        'A-' || CAST({_TOP} + row_number() OVER (ORDER BY okey) AS STRING) AS target_key FROM ({_SALES_NEW})""",
    "load_log": """SELECT CAST("order" AS INTEGER) AS "order", "table", key_field, count(*) AS submitted, count(*) FILTER (accepted) AS succeeded,
        count(*) FILTER (NOT accepted) AS failed, CASE WHEN bool_or(aborted) THEN 'failed' WHEN count(*) FILTER (NOT accepted) > 0 THEN 'partial'
        ELSE 'success' END AS status FROM {outcomes} GROUP BY 1, 2, 3""",
    "load_summary": """SELECT coalesce("table", 'TOTAL') AS "table", count(*) AS submitted, count(*) FILTER (accepted) AS succeeded,
        count(*) FILTER (NOT accepted) AS failed FROM {outcomes} GROUP BY ROLLUP ("table")""",
    "rollback_plan": """SELECT "table", CAST(max("order") AS INTEGER) AS "order", count(*) FILTER (accepted) AS records FROM {outcomes}
        GROUP BY 1 HAVING count(*) FILTER (accepted) > 0""",
    "loaded_ids": f"""SELECT CAST(c_custkey AS STRING) AS target_id, nullif({trim('c_key')}, '') AS key FROM {{customer_keys}}
        UNION ALL SELECT CAST(s_suppkey AS STRING), s_name FROM {{supplier}}""",
    "result_files": """SELECT o_orderkey, error, 'orders' AS "table", CASE WHEN error IS NULL THEN 'success' ELSE 'failure' END AS outcome FROM {rejects}""",
    "rollback": "SELECT * FROM {sales}",
    "rollback_by_key": "SELECT * FROM {sales}",
    "rollback_report": """WITH x AS (SELECT b.price, s.okey IS NOT NULL AS old FROM {sales_batch} b LEFT JOIN {sales} s ON s.okey = b.okey)
        SELECT 'sales' AS "table", count(*) AS logged, count(*) FILTER (NOT old AND price < 400000) AS deleted,
            count(*) FILTER (old AND price < 400000) AS restored,
            CASE WHEN count(*) FILTER (price < 400000) = 0 THEN 'SKIP' WHEN count(*) FILTER (price < 400000) < count(*) THEN 'PARTIAL' ELSE 'OK' END AS status FROM x""",

    "manifest": """WITH f(tier, "order", "table", key_field) AS (VALUES (0, 1, 'part', NULL), (0, 2, 'region', 'r_name'), (1, 3, 'nation', 'n_name'),
            (2, 4, 'customer', 'c_name'), (2, 5, 'supplier', 's_name'), (3, 6, 'orders', NULL), (4, 7, 'lineitem', NULL)),
        n AS (SELECT 'part' AS "table", count(*) AS r FROM {part} UNION ALL SELECT 'region', count(*) FROM {region}
            UNION ALL SELECT 'nation', count(*) FROM {nation} UNION ALL SELECT 'customer', count(*) FROM {customer}
            UNION ALL SELECT 'supplier', count(*) FROM {supplier} UNION ALL SELECT 'orders', count(*) FROM {orders}
            UNION ALL SELECT 'lineitem', count(*) FROM {lineitem})
        SELECT 'full' AS mode, CAST(tier AS INTEGER) AS tier, CAST("order" AS INTEGER) AS "order",
            'tier-' || tier || '/0' || "order" || '-' || "table" AS path, "table", key_field, r AS "rows",
            CASE WHEN key_field IS NULL THEN 'insert' ELSE 'upsert' END AS operation, FALSE AS pass2, CAST(NULL AS STRING) AS notes FROM f JOIN n USING ("table")""",
    "plan": """WITH x AS (SELECT 1 AS "order", 0 AS tier, 'part' AS "table", count(*) AS records, '(composite key)' AS key FROM {part}
            UNION ALL SELECT 2, 1, 'nation', count(*), 'n_name' FROM {nation} UNION ALL SELECT 3, 2, 'customer', count(*), 'c_name' FROM {customer}
            UNION ALL SELECT 4, 2, 'supplier', count(*), 's_name' FROM {supplier} UNION ALL SELECT 5, 3, 'orders', count(*), NULL FROM {orders}
            UNION ALL SELECT 6, 4, 'lineitem', count(*), NULL FROM {lineitem})
        SELECT * FROM x UNION ALL SELECT NULL, NULL, 'TOTAL', CAST(sum(records) AS BIGINT), NULL FROM x""",
    "export_load_roundtrip": """WITH n AS (SELECT 'region' AS "table", count(*) AS c FROM {region} UNION ALL SELECT 'nation', count(*) FROM {nation}
            UNION ALL SELECT 'customer', count(*) FROM {customer} UNION ALL SELECT 'supplier', count(*) FROM {supplier}
            UNION ALL SELECT 'orders', count(*) FROM {orders} UNION ALL SELECT 'lineitem', count(*) FROM {lineitem})
        SELECT "table", c AS source, c AS target, CAST(0 AS BIGINT) AS new, CAST(0 AS BIGINT) AS modified, CAST(0 AS BIGINT) AS deleted, c AS identical FROM n""",
    "delta_roundtrip": """SELECT 'customer' AS "table", count(*) AS source, count(*) AS target, CAST(0 AS BIGINT) AS new, CAST(0 AS BIGINT) AS modified,
            CAST(0 AS BIGINT) AS deleted, count(*) AS identical FROM {customer}
        UNION ALL SELECT 'orders', count(*), count(*) + count(*) FILTER (o_orderkey % 13 = 0), 0, 0, count(*) FILTER (o_orderkey % 13 = 0), count(*) FROM {orders}""",
    "bundle_csv": """SELECT CAST(o_orderkey AS STRING) AS o_orderkey, c_name AS customer_name, o_orderpriority FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "load_rollback": """SELECT o_orderkey, 'O-' || CAST(o_orderkey AS STRING) AS o_key, o_custkey, o_orderstatus, o_totalprice FROM {orders_tgt}""",
    "load_rollback_flags": "SELECT * FROM {sales}",
    "load_unreadable": """WITH b AS (SELECT *, CAST(_source_id AS BIGINT) % 10 = 0 AS bad FROM {sales_batch})
        SELECT okey, CAST(NULL AS STRING) AS status, CAST(NULL AS DOUBLE) AS price, 'INVALID_VALUE:price' AS error FROM b WHERE bad
        UNION ALL SELECT s.okey, coalesce(b.status, s.status), coalesce(b.price, s.price), NULL FROM {sales} s LEFT JOIN b ON s.okey = b.okey AND NOT bad
        UNION ALL SELECT okey, status, price, NULL FROM b WHERE NOT bad AND okey NOT IN (SELECT okey FROM {sales})""",
    "load_stopped": f"""SELECT 'undone' AS state, id, okey, status, price, active FROM {{sales}}
        UNION ALL SELECT 'stopped', s.id, s.okey, coalesce(b.status, s.status), coalesce(b.price, s.price), s.active FROM {{sales}} s LEFT JOIN {{sales_batch}} b ON s.okey = b.okey
        UNION ALL SELECT 'stopped', {_TOP} + row_number() OVER (ORDER BY CAST(_source_id AS BIGINT)), okey, status, price, NULL
        FROM {{sales_batch}} WHERE okey NOT IN (SELECT okey FROM {{sales}})""",
    "load_counters": """WITH b AS (SELECT b.*, s.okey IS NOT NULL AS known FROM {sales_batch} b LEFT JOIN {sales} s ON s.okey = b.okey)
        SELECT 'sales' AS "table", counter, CAST(n AS BIGINT) AS n FROM (SELECT 'read' AS counter, count(*) AS n FROM b
        UNION ALL SELECT 'inserted', count(*) FILTER (NOT known) FROM b UNION ALL SELECT 'updated', count(*) FILTER (known) FROM b
        UNION ALL SELECT unnest(['references_found', 'references_missed', 'masked', 'repeated_keys']), 0)""",
    "mixed_references": """SELECT c.c_name, CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_name ELSE p.c_name END AS refers_to
        FROM {customer_mixed} c LEFT JOIN {supplier} s ON c.ref = s.s_suppkey LEFT JOIN {customer_mixed} p ON c.ref = p.c_custkey""",
}

ORACLE_SQL = {name: sql(text) for name, text in ORACLES.items()}
