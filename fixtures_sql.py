"""Derived inputs of the registered queries.

Each text is plain SELECT syntax that Spark and DuckDB read alike, so both engines start from the
same rows; everything after that is computed independently. Braces name base tables or other
entries. All derivations cover their base table as a whole: the conditions below decide how a row
differs between two environments, not how many rows are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "labels", "conversations", "pages", "benchmark", "embeddings")

FIXTURES = {
    # A later snapshot of orders: some gone, some repriced, some new.
    "orders_tgt": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 11 <> 0
        UNION ALL
        SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 13 = 0""",
    "orders_money": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
               o_orderpriority FROM {orders}""",
    "orders_tgt_money": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus,
               CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority FROM {orders_tgt}""",
    "customer_tgt": """
        SELECT c_custkey * 10 + 3 AS c_custkey, c_name, c_nationkey,
               CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM {customer} WHERE c_custkey % 11 <> 0""",
    "events_tgt": """
        SELECT event_id, ts, user_id, event_type, value, props FROM {events} WHERE event_id % 10 <> 0
        UNION ALL
        SELECT event_id + 100000000, ts, user_id, event_type, value, props FROM {events} WHERE event_id % 25 = 0""",
    # Edited at the very end of the text, relabelled, gone, new; an empty label equals no label.
    "documents_tgt": """
        SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || '.' ELSE text END AS text,
               CASE WHEN doc_id % 9 = 0 THEN 'xx' ELSE lang END AS lang, source, n_chars
        FROM {documents} WHERE doc_id % 11 <> 0
        UNION ALL SELECT doc_id + 100000000, text, lang, source, n_chars FROM {documents} WHERE doc_id % 13 = 0""",
    # Keys that are empty, null or padded.
    "customer_keys": """
        SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN NULL
                               WHEN c_custkey % 23 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS c_key,
               c_nationkey, c_acctbal, c_mktsegment FROM {customer}""",
    "lineitem_keys": """
        SELECT CASE WHEN l_partkey % 17 = 0 THEN '' WHEN l_partkey % 19 = 0 THEN NULL
                    WHEN l_partkey % 23 = 0 THEN ' ' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || ' '
                    ELSE CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS l_key,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate FROM {lineitem}""",
    "part_keys": "SELECT p_partkey, 'P-' || CAST(p_partkey AS STRING) AS p_key, p_size FROM {part}",
    "order_keys": "SELECT o_orderkey, 'O-' || CAST(o_orderkey AS STRING) AS o_key, o_custkey FROM {orders}",
    "customer_party": "SELECT 'C' || CAST(c_custkey AS STRING) AS party_id, c_name AS party_key FROM {customer}",
    "supplier_party": "SELECT 'S' || CAST(s_suppkey AS STRING) AS party_id, s_name AS party_key FROM {supplier}",
    "event_party": """
        SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'C' || CAST(user_id AS STRING)
                              ELSE 'S' || CAST(user_id AS STRING) END AS party_id FROM {events}""",
    "turns": """
        SELECT CAST(conv_id AS STRING) || '/' || CAST(turn AS STRING) AS id,
               'K-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS turn_key,
               CASE WHEN turn > 0 THEN CAST(conv_id AS STRING) || '/' || CAST(turn - 1 AS STRING) END AS reply_to,
               conv_id, turn FROM {conversations}""",
    # First turns of some conversations answer their last turn, others their second turn.
    "turn_edges_cycle": """
        SELECT t.id AS child, t.reply_to AS parent FROM {turns} t WHERE t.reply_to IS NOT NULL
        UNION ALL
        SELECT t.id, CAST(t.conv_id AS STRING) || '/' || CAST(m.last_turn AS STRING) FROM {turns} t
        JOIN (SELECT conv_id, MAX(turn) AS last_turn FROM {turns} GROUP BY conv_id) m ON t.conv_id = m.conv_id
        WHERE t.turn = 0 AND m.last_turn > 0 AND t.conv_id % 10 = 0
        UNION ALL
        SELECT t.id, t.id_second FROM (SELECT id, conv_id, turn, CAST(conv_id AS STRING) || '/1' AS id_second FROM {turns}) t
        JOIN (SELECT conv_id, MAX(turn) AS last_turn FROM {turns} GROUP BY conv_id) m ON t.conv_id = m.conv_id
        WHERE t.turn = 0 AND m.last_turn > 0 AND t.conv_id % 10 = 1""",
    "lineitem_ids": """
        SELECT 'L' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' ||
               CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS l_id,
               l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM {lineitem}""",
    # Every row of the star schema as a node, every foreign key value as an edge, some of them twice.
    "row_nodes": """
        SELECT 'R' || CAST(r_regionkey AS STRING) AS node, 0 AS expected FROM {region}
        UNION ALL SELECT 'N' || CAST(n_nationkey AS STRING), 1 FROM {nation}
        UNION ALL SELECT 'C' || CAST(c_custkey AS STRING), 2 FROM {customer}
        UNION ALL SELECT 'S' || CAST(s_suppkey AS STRING), 2 FROM {supplier}
        UNION ALL SELECT 'P' || CAST(p_partkey AS STRING), 0 FROM {part}
        UNION ALL SELECT 'O' || CAST(o_orderkey AS STRING), 3 FROM {orders}
        UNION ALL SELECT l_id, 4 FROM {lineitem_ids}""",
    "row_edges": """
        SELECT 'N' || CAST(n_nationkey AS STRING) AS child, 'R' || CAST(n_regionkey AS STRING) AS parent FROM {nation}
        UNION ALL SELECT 'C' || CAST(c_custkey AS STRING), 'N' || CAST(c_nationkey AS STRING) FROM {customer}
        UNION ALL SELECT 'S' || CAST(s_suppkey AS STRING), 'N' || CAST(s_nationkey AS STRING) FROM {supplier}
        UNION ALL SELECT 'O' || CAST(o_orderkey AS STRING), 'C' || CAST(o_custkey AS STRING) FROM {orders}
        UNION ALL SELECT l_id, 'O' || CAST(l_orderkey AS STRING) FROM {lineitem_ids}
        UNION ALL SELECT l_id, 'P' || CAST(l_partkey AS STRING) FROM {lineitem_ids}
        UNION ALL SELECT l_id, 'P' || CAST(l_partkey AS STRING) FROM {lineitem_ids}
        UNION ALL SELECT l_id, 'S' || CAST(l_suppkey AS STRING) FROM {lineitem_ids}""",
    "customer_mail": """
        SELECT c_custkey, c_name,
               CASE WHEN c_custkey % 4 = 0 THEN LOWER(REPLACE(c_name, '#', '')) || '@example.com.invalid'
                    WHEN c_custkey % 5 = 0 THEN 'unknown'
                    WHEN c_custkey % 6 = 0 THEN NULL
                    ELSE LOWER(REPLACE(c_name, '#', '')) || '@example.com' END AS contact_email,
               CASE WHEN c_custkey % 3 = 0 THEN 'none'
                    WHEN c_custkey % 7 = 0 THEN ''
                    ELSE ' c' || CAST(c_custkey AS STRING) || '@shop.example.org ' END AS login,
               CASE WHEN c_custkey % 3 = 0 THEN 'c' || CAST(c_custkey AS STRING) || '@few.example.org'
                    ELSE 'n/a' END AS remark
        FROM {customer}""",
    "rules": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE 'R-' || CAST(o_orderkey AS STRING) END AS rule_key,
               CASE WHEN o_orderkey % 5 = 0 THEN 'Custom' ELSE 'All' END AS conditions,
               CASE WHEN o_orderkey % 10 = 5 THEN NULL ELSE o_orderpriority END AS advanced
        FROM {orders}""",
    "rejects": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderkey % 4 = 0 THEN 'UNABLE_TO_LOCK_ROW: unable to obtain exclusive access'
                    WHEN o_orderkey % 4 = 1 THEN 'error: Too many retries of batch save in the presence of failures'
                    WHEN o_orderkey % 4 = 2 THEN 'REQUIRED_FIELD_MISSING: [o_custkey]'
                    ELSE NULL END AS error
        FROM {orders}""",
    "orders_check": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'O-' || CAST(o_orderkey % 100000 AS STRING) END AS o_key,
               CASE WHEN o_orderkey % 9 = 0 THEN '  ' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority, o_custkey,
               CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 'C-' || CAST(o_custkey AS STRING) END AS customer__key
        FROM {orders} UNION ALL
        SELECT o_orderkey + 100000000, 'O-' || CAST(o_orderkey AS STRING), o_orderstatus, o_orderpriority, o_custkey,
               'C-' || CAST(o_custkey AS STRING) FROM {orders} WHERE o_orderkey % 31 = 0""",
    "taken_keys": "SELECT 'O-' || CAST(o_orderkey AS STRING) AS o_key FROM {orders} WHERE o_orderkey % 37 = 0",
    "supplier_key_xwalk": """
        SELECT 'supplier' AS "table", 's_name' AS key_field, s_name AS source_key,
               'N-' || CAST(s_suppkey AS STRING) AS target_key FROM {supplier} WHERE s_suppkey % 3 = 0""",
    "customer_xwalk": """
        SELECT 'customer' AS "table", LPAD(CAST(c_custkey AS STRING), 15, '0') AS source_id,
               LPAD(CAST(c_custkey * 10 + 3 AS STRING), 15, '0') AS target_id
        FROM {customer} WHERE c_custkey % 9 <> 0""",
    "orders_raw": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'ext-' || CAST(o_custkey AS STRING)
                                WHEN o_orderkey % 8 = 0 THEN NULL
                                ELSE LPAD(CAST(o_custkey AS STRING), 15, '0') END AS cust_ref,
               CASE WHEN o_orderkey % 4 = 0 THEN 'C-' || CAST(o_custkey AS STRING)
                    WHEN o_orderkey % 6 = 0 THEN ' ' END AS customer__key FROM {orders}""",
    "customer_numbered": """
        SELECT c_custkey * 10 + 3 AS c_custkey,
               CASE WHEN c_custkey % 6 = 0 THEN 'T-' || CAST(c_custkey AS STRING) ELSE c_name END AS c_name
        FROM {customer} WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0
        UNION ALL SELECT c_custkey * 10 + 7, c_name FROM {customer} WHERE c_custkey % 13 = 1""",
    "customer_key_xwalk": """
        SELECT c_name AS source_key, 'T-' || CAST(c_custkey AS STRING) AS target_key
        FROM {customer} WHERE c_custkey % 6 = 0""",
    "part_tgt": "SELECT p_partkey * 10 + 3 AS p_partkey, p_name FROM {part} WHERE p_partkey % 4 <> 0",
    "supplier_tgt": """
        SELECT s_suppkey * 10 + 3 AS s_suppkey, s_name, s_nationkey * 10 + 3 AS s_nationkey
        FROM {supplier} WHERE s_suppkey % 5 <> 0""",
    "nation_tgt": "SELECT n_nationkey * 10 + 3 AS n_nationkey, n_name FROM {nation}",
    # A target table with its own ids, and a batch for it.
    # Customers that refer to a supplier, to another customer, or to nobody; ids of both tables overlap, the first target counts.
    "customer_mixed": """
        SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 50 WHEN c_custkey % 3 = 1 THEN c_custkey + 1 END AS ref FROM {customer}""",
    "sales": """
        SELECT o_orderkey * 10 + 3 AS id, 'O-' || CAST(o_orderkey AS STRING) AS okey, o_orderstatus AS status,
               o_totalprice AS price, o_orderpriority AS priority, o_orderkey % 3 = 0 AS active
        FROM {orders} WHERE o_orderkey % 11 <> 0""",
    "sales_batch": """
        SELECT CAST(o_orderkey AS STRING) AS _source_id, 'O-' || CAST(o_orderkey AS STRING) AS okey,
               'X' AS status, o_totalprice + 1 AS price FROM {orders} WHERE o_orderkey % 2 = 0""",
    "outcomes": """
        SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS "order",
               CASE WHEN l_linestatus = 'O' THEN 'open_lines' ELSE 'closed_lines' END AS "table", 'l_key' AS key_field,
               NOT (l_linestatus = 'F' AND l_quantity > 45) AS accepted, FALSE AS aborted FROM {lineitem}
        UNION ALL SELECT 3, 'orders', 'o_key', TRUE, TRUE FROM {orders}""",
}


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a derived one."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = FIXTURES[name].replace('"', "`")
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in _names(text)})


def sql(text: str) -> str:
    """A DuckDB statement with the derived tables it names as common table expressions."""
    order: list[str] = []

    def visit(part: str) -> None:
        for n in _names(part):
            if n not in BASE and n not in order:
                visit(FIXTURES[n])
                order.append(n)

    visit(text)
    plain = lambda s: re.sub(r"\{(\w+)\}", r"\1", s)
    ctes = [f"{n} AS ({plain(FIXTURES[n])})" for n in order]
    body = plain(text).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(ctes)}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"
