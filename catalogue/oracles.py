"""For each query, SQL over the same tables that must give the same rows."""

from __future__ import annotations

DAY = "CAST(strftime(ts, '%Y%m%d') || '120000' AS BIGINT)"

# Supplier names for the two codes of a line; a code without a supplier has none.
LINES = """
FROM lineitem
LEFT JOIN supplier s ON s.s_suppkey = l_suppkey
LEFT JOIN supplier p ON p.s_suppkey = l_partkey
"""
LINE_CODES = "',' || l_suppkey || ',' || l_partkey || ',' AS codes"
LOOKUP_BY_ID = f"""
SELECT l_orderkey, l_linenumber, {LINE_CODES},
       coalesce(s.s_name, 'NA') || ';' || coalesce(p.s_name, 'NA') AS names {LINES}"""

PRIORITY = "lower(substr(o_orderpriority, 3))"
LOOKUP_BY_USER = f"""
SELECT o_orderkey, o_orderpriority || '|' || o_orderstatus || '|' || o_orderpriority AS codes,
       {PRIORITY} || '+?+' || {PRIORITY} AS labels
FROM orders"""

LOOKUP_SQL = f"""
SELECT coalesce(s.s_name, 'NA') || ';' || coalesce(p.s_name, 'NA') AS names,
       coalesce(s.s_name, 'NA') AS name,
       l_orderkey, l_linenumber, l_suppkey, o_orderpriority, {LINE_CODES},
       {PRIORITY} AS priority
{LINES}
JOIN orders ON l_orderkey = o_orderkey"""

LOOKUP_ORDER_BY = f"""
SELECT l_orderkey, l_linenumber, l_suppkey {LINES}
ORDER BY coalesce(s.s_name, 'NA') || ';' || coalesce(p.s_name, 'NA') DESC, l_orderkey, l_linenumber
LIMIT 500"""

LOOKUP_EXPLODE = f"""
SELECT l_orderkey, l_linenumber, 0 AS position, coalesce(s.s_name, 'NA') AS name {LINES}
UNION ALL SELECT l_orderkey, l_linenumber, 1 AS position, coalesce(p.s_name, 'NA') AS name {LINES}"""

LOOKUP_JOIN_ON = f"""
SELECT l_orderkey, l_linenumber, s_suppkey, o_orderpriority FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
WHERE {PRIORITY} <> 'low'"""

EDGE_CASES = f"""
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'NA' WHEN 3 THEN ''
            WHEN 4 THEN s || ';NA;' || p
            WHEN 5 THEN s || ';' || s || ';' || s
            WHEN 6 THEN 'NA;NA;' || p
            ELSE p || ';' || s || ';' || p END AS names
FROM (SELECT l_orderkey, l_linenumber, coalesce(s.s_name, 'NA') AS s,
             coalesce(p.s_name, 'NA') AS p {LINES})"""

DERIVED = """
SELECT o_orderkey * 10 + o_custkey AS mixed, lower(o_orderstatus) AS status,
       o_orderkey, o_custkey, o_orderstatus, o_orderstatus || '-' || o_custkey AS label
FROM orders"""

JOB = """
SELECT 20240102030405 AS run_id, o_orderkey AS order_id, c_custkey AS customer_id, n_name,
       o_orderstatus AS status, ',' || c_custkey || ',' || o_orderkey || ',' AS codes,
       CAST(strftime(o_orderdate, '%Y%m01120000') AS BIGINT) AS business_effective_timestamp,
       c.c_name || ';' || coalesce(o.c_name, 'none') AS names,
       'status ' || o_orderstatus AS status_label
FROM orders JOIN (SELECT c_custkey, c_name, c_nationkey FROM customer) c ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT c_custkey AS k, c_name FROM customer) o ON o.k = o_orderkey"""

ORACLES: dict[str, str] = {
    "scan_parquet_merged": """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "scan_full": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "scan_latest_snapshot": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
    "latest_key": """
SELECT CAST(max(year(o_orderdate)) || '0101000000' AS BIGINT) AS batch_id, count(*) AS n_orders
FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
    "scan_historical_materialized": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem""",
    "cache_disk": """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users
FROM events GROUP BY event_type""",
    "source_selection": "SELECT count(*) AS n_rows, 1 AS n_sources FROM orders",
    "file_inventory": """
SELECT DISTINCT CAST(year(o_orderdate) || '0101000000' AS BIGINT) AS batch_id,
       true AS has_files, true AS has_bytes, true AS has_time
FROM orders""",
    "inventory_limit": """
SELECT CAST(3 AS BIGINT) AS n_files, count(DISTINCT year(o_orderdate)) > 3 AS after FROM orders""",
    "read_text": "SELECT props AS value, count(*) AS n FROM events GROUP BY props",
    "read_text_whole": "SELECT props AS value, count(*) AS n FROM events GROUP BY props",
    "read_header_map": """
SELECT CAST(n_nationkey AS VARCHAR) AS line, unnest(['n_nationkey', 'n_name', 'n_regionkey'])
       AS attribute, unnest([CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)])
       AS value
FROM nation""",
    "read_header_map_objects": """
SELECT CAST(n_nationkey AS VARCHAR) AS line, unnest(['n_nationkey', 'n_name']) AS attribute,
       unnest([CAST(n_nationkey AS VARCHAR), n_name]) AS value
FROM nation
UNION ALL
SELECT CAST(r_regionkey AS VARCHAR), unnest(['r_name', 'r_regionkey']),
       unnest([r_name, CAST(r_regionkey AS VARCHAR)])
FROM region""",
    "sql_step_join_agg": """
SELECT n_name, count(*) AS n_orders,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name""",
    "sql_step_semi_anti": """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS has_orders FROM customer""",
    "sql_step_outer_join": """
SELECT n_name,
       nullif((SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey), 0) AS n_customers,
       nullif((SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey), 0) AS n_suppliers
FROM nation""",
    "sql_step_window_topk": """
SELECT o_custkey, o_orderkey, CAST(row_number() OVER (
       PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place
FROM orders QUALIFY place <= 3""",
    "sql_step_setops": """
SELECT 'union' AS op, k FROM (SELECT CAST(c_nationkey AS BIGINT) AS k FROM customer
       UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', k FROM (SELECT c_nationkey AS k FROM customer
       INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except', k FROM (SELECT c_custkey AS k FROM customer
       EXCEPT SELECT s_suppkey FROM supplier)""",
    "sql_step_rollup": """
SELECT l_returnflag, l_linestatus,
       CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS level, count(*) AS n,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY ROLLUP(l_returnflag, l_linestatus)""",
    "cast_id_columns": """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS "Line_Id",
       CAST(trunc(l_extendedprice) AS BIGINT) AS price_id,
       CAST(trunc(CAST(l_discount AS DECIMAL(6, 2))) AS BIGINT) AS "discount_ID",
       CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END::BIGINT AS large_id,
       l_returnflag AS flag_id, l_quantity AS quantity
FROM lineitem""",
    "derived_pre_post": DERIVED,
    "derived_assemble": """
SELECT unnest(['mixed', 'status', 'o_orderkey', 'o_custkey', 'o_orderstatus', 'label']) AS column,
       unnest([0, 1, 2, 3, 4, 5]) AS place, n
FROM (SELECT count(*) AS n FROM orders)""",
    "derived_param": """
SELECT 20210502120001 AS run_id, o_orderkey, o_custkey AS cust_id, 'nightly' AS job
FROM orders""",
    "json_attr": """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'null_string') AS k,
       coalesce(json_extract_string(props, '$.k'), 'null_string') AS same,
       coalesce(json_extract_string(props, '$.absent.path'), 'null_string') AS absent
FROM events""",
    "json_nodes": """
SELECT event_id, json_extract_string(props, '$.k') AS k, 'null_string' AS value
FROM events, (SELECT unnest([1, 2]) AS twice) WHERE event_type = 'click'
UNION ALL
SELECT event_id, json_extract_string(props, '$.k'), 'null_string'
FROM events WHERE event_type = 'view'
UNION ALL
SELECT event_id, 'null_string', unnest([CAST(event_id AS VARCHAR), event_type])
FROM events WHERE event_type = 'purchase'""",
    "lookup_by_id": LOOKUP_BY_ID,
    "lookup_by_id_joined": LOOKUP_BY_ID,
    "lookup_by_id_sharded": LOOKUP_BY_ID,
    "lookup_by_user": LOOKUP_BY_USER,
    "lookup_by_user_joined": LOOKUP_BY_USER,
    "lookup_by_user_sharded": LOOKUP_BY_USER,
    "lookup_null_no_match": LOOKUP_BY_ID.replace("'NA'", "'null'"),
    "lookup_sql_functions": LOOKUP_SQL,
    "lookup_sql_functions_joined": LOOKUP_SQL,
    "lookup_edge_cases": EDGE_CASES,
    "lookup_edge_cases_joined": EDGE_CASES,
    "lookup_edge_cases_sharded": EDGE_CASES,
    "lookup_sql_edge_cases": EDGE_CASES,
    "lookup_sql_edge_cases_joined": EDGE_CASES,
    "lookup_sql_order_by": LOOKUP_ORDER_BY,
    "lookup_sql_order_by_joined": LOOKUP_ORDER_BY,
    "lookup_sql_explode": LOOKUP_EXPLODE,
    "lookup_sql_explode_joined": LOOKUP_EXPLODE,
    "lookup_sql_join_on": LOOKUP_JOIN_ON,
    "lookup_sql_join_on_joined": LOOKUP_JOIN_ON,
    "lookup_wrong_kind": """
SELECT l_orderkey, l_linenumber, 'NA;NA' AS by_id, 'NA' AS by_user FROM lineitem""",
    "lookup_build": """
SELECT user_id AS key, max(event_type) AS label FROM events GROUP BY user_id""",
    "lookup_size": """
SELECT 'priorities' AS name, count(DISTINCT o_orderpriority) AS counted,
       CAST(count(DISTINCT o_orderpriority) AS INTEGER) AS reported
FROM orders""",
    "lookup_dedupe": """
SELECT count(DISTINCT c_custkey) AS n_keys, 2 AS specs, 1 AS lookups FROM customer""",
    "distinct_effective_keys": f"""
SELECT DISTINCT {DAY} AS business_effective_timestamp FROM events""",
    "write_append": "SELECT c_custkey, 2 * count(*) AS n FROM customer GROUP BY c_custkey",
    "write_append_partitioned": "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer",
    "append_union": """
SELECT c_name AS name, c_mktsegment AS segment, NULL AS nation FROM customer
UNION ALL SELECT s_name, NULL, s_nationkey FROM supplier""",
    "replace_by_key": f"""
SELECT event_id, event_type, CASE WHEN {DAY} BETWEEN 20240110120000 AND 20240112120000
       THEN 2 ELSE 1 END AS version, {DAY} AS bet
FROM events""",
    "replace_by_key_subpartitions": f"""
SELECT event_id, event_type, CASE WHEN {DAY} BETWEEN 20240110120000 AND 20240112120000
       THEN 2 ELSE 1 END AS version, {DAY} AS bet
FROM events
WHERE event_type <> 'click' OR NOT {DAY} BETWEEN 20240110120000 AND 20240112120000""",
    "replace_by_key_unpartitioned": f"""
SELECT event_type, {DAY} AS business_effective_timestamp, 2 * count(*) AS n
FROM events GROUP BY event_type, {DAY}""",
    "replace_by_key_after_a_crash": f"""
SELECT event_id, event_type, CASE WHEN {DAY} BETWEEN 20240110120000 AND 20240112120000
       THEN 2 ELSE 1 END AS version, {DAY} AS bet
FROM events
WHERE event_type <> 'click' OR NOT {DAY} BETWEEN 20240110120000 AND 20240112120000""",
    "replace_by_key_rerun": f"""
SELECT event_id, event_type, 2 AS version, {DAY} AS bet FROM events""",
    "external_table_roundtrip": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "repair_partitions": """
SELECT DISTINCT 'c_mktsegment=' || c_mktsegment AS partition FROM customer""",
    "catalog_type_names": """
SELECT o_orderkey, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d %H:%M:%S') AS o_year,
       'bigint' AS type_0, 'double' AS type_1, 'string' AS type_2
FROM orders""",
    "write_partition_count": "SELECT count(*) AS n_rows, true AS enough FROM orders",
    "step_filter": """
SELECT count(*) AS n_rows, true AS done_exists, false AS ignored_exists FROM customer""",
    "fail_fast": """
SELECT count(*) AS n_rows, 'Generate output' AS stage, false AS late_exists,
       CAST(1 AS BIGINT) AS n_errors
FROM customer""",
    "run_job": JOB,
    "run_job_large_lookup": JOB,
    "run_job_daily": """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(strftime(o_orderdate, '%Y%m01120000') AS BIGINT) AS business_effective_timestamp
FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
    "run_job_historical": f"""
SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       {DAY} AS business_effective_timestamp
FROM events GROUP BY event_type, {DAY}""",
    "job_log_time": """
SELECT unnest(['customer', 'orders', 'nation', 'events']) AS source,
       (SELECT count(*) FROM customer) > 0 AS same""",
    "run_job_second_step": f"""
SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       {DAY} AS business_effective_timestamp
FROM events GROUP BY event_type, {DAY}""",
    "job_log": """
SELECT 'INFO' AS level, 'build lookups' AS step,
       'customer_names has ' || count(DISTINCT c_custkey) || ' keys' AS msg,
       'catalogue' AS job_name, 20240102030405 AS batch_id
FROM customer
UNION ALL
SELECT 'INFO', 'build lookups',
       'statuses has ' || count(DISTINCT o_orderstatus) || ' keys', 'catalogue',
       20240102030405
FROM orders""",
}
