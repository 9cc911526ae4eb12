"""One query per operator, over the whole given tables.

Queries that need a dataset of a certain shape (snapshots, drifting schemas, text)
let Spark derive it from the tables, in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepweave.config import STEP_TYPE, DerivedColumn, Job, LookupSpec, Source, Step, write_files
from stepweave.functions.json import json_attr, json_nodes
from stepweave.operators import lookups as L
from stepweave.operators import publish
from stepweave.operators.catalog import create_external_table, repair_partitions
from stepweave.operators.columns import cast_id_columns, derive_columns
from stepweave.operators.publish import EFFECTIVE_KEY
from stepweave.plans.job import run_job
from stepweave.plans.step import StepFailed, sql_step, step_output
from stepweave.session import scratch_path
from stepweave.sources import files, parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LARGE = -1  # a broadcast limit that no lookup meets


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        parquet.register_view(table(spark, sf_dir, name), name)


def job(**given) -> Job:
    base = dict(name="catalogue", batch_id=20240101120000, database="default")
    return Job(**{**base, "base_path": "", "log_table": "job_log", **given})


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the day as effective-time key."""
    day = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("120000")).cast("bigint")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", day.alias(EFFECTIVE_KEY)
    )


def order_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """Orders as one snapshot per year; the path."""
    path = scratch_path(spark, "order_snapshots")
    batch = F.concat(F.year("o_orderdate"), F.lit("0101000000")).cast("bigint")
    orders = table(spark, sf_dir, "orders").withColumn("batch_id", batch)
    publish.write_append(orders, path, ["batch_id"])
    return path


# Scans and sources


@query
def scan_parquet_merged(spark, sf_dir):
    path = scratch_path(spark, "drifting_orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    late = F.col("o_orderdate") >= "1998-01-01"
    publish.write_append(orders.where(~late).drop("o_orderpriority"), path)
    publish.write_append(orders.where(late), path)
    merged = parquet.scan_parquet_merged(spark, path)
    return merged.select("o_orderkey", "o_custkey", "o_orderpriority")


@query
def scan_full(spark, sf_dir):
    source = Source(f"{sf_dir}/customer.parquet", "all_customers")
    parquet.load_source(spark, source, job())
    return spark.sql("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM all_customers")


@query
def scan_latest_snapshot(spark, sf_dir):
    path = order_snapshots(spark, sf_dir)
    daily = job(job_type="daily", snapshot_views=("newest_orders",))
    df = parquet.load_source(spark, Source(path, "newest_orders"), daily)
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query
def latest_key(spark, sf_dir):
    path = order_snapshots(spark, sf_dir)
    newest = parquet.latest_snapshot(spark, path)
    return parquet.scan_latest_snapshot(spark, path).agg(
        F.lit(int(newest)).alias("batch_id"), F.count("*").alias("n_orders")
    )


@query
def scan_historical_materialized(spark, sf_dir):
    source = Source(f"{sf_dir}/lineitem.parquet", "historical_lines")
    df = parquet.load_source(spark, source, job(job_type="historical"))
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query
def cache_disk(spark, sf_dir):
    source = Source(f"{sf_dir}/events.parquet", "cached_events", cache=True)
    parquet.load_source(spark, source, job())
    return spark.sql(
        "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users "
        "FROM cached_events GROUP BY event_type"
    )


@query
def source_selection(spark, sf_dir):
    """Views come from object and relationship steps only, each source once."""
    orders = Source(f"{sf_dir}/orders.parquet", "selected_orders")
    events = Source(f"{sf_dir}/events.parquet", "unselected_events")
    steps = (
        Step("a", "", "Object", (orders,)),
        Step("b", "", "relationship", (orders,)),
        Step("c", "", "other", (events,)),
    )
    chosen = job(steps=steps)
    loaded = [parquet.load_source(spark, s, chosen) for s in chosen.sources()]
    return loaded[0].agg(F.count("*").alias("n_rows"), F.lit(len(loaded)).alias("n_sources"))


@query
def file_inventory(spark, sf_dir):
    listed = files.file_inventory(spark, order_snapshots(spark, sf_dir))
    batch = F.regexp_extract("path", r"/batch_id=(\d+)/[^/]+\.parquet$", 1).cast("bigint")
    return listed.groupBy(batch.alias("batch_id")).agg(
        (F.count("*") > 0).alias("has_files"),
        (F.min("size") > 0).alias("has_bytes"),
        F.bool_and(F.col("modified").isNotNull()).alias("has_time"),
    )


@query
def inventory_limit(spark, sf_dir):
    path = order_snapshots(spark, sf_dir)
    first = files.file_inventory(spark, path, limit=1).first().path
    after = files.file_inventory(spark, path, start_after=first, limit=3)
    return after.agg(F.count("*").alias("n_files"), F.bool_and(F.col("path") > first).alias("after"))


@query
def read_text(spark, sf_dir):
    path = scratch_path(spark, "props")
    table(spark, sf_dir, "events").select("props").write.text(path)
    return files.read_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


@query
def read_text_whole(spark, sf_dir):
    path = scratch_path(spark, "props")
    table(spark, sf_dir, "events").select("props").hint("rebalance").write.text(path)
    whole = files.read_whole(spark, path).where("value <> ''")
    lines = whole.select(F.explode(F.split("value", "\r\n")).alias("value"))
    return lines.groupBy("value").agg(F.count("*").alias("n"))


@query
def read_header_map(spark, sf_dir):
    """Nations as one text object; its header comes first."""
    path = scratch_path(spark, "nations")
    nations = table(spark, sf_dir, "nation")
    nations.select("n_nationkey", "n_name", "n_regionkey").coalesce(1).write.csv(path, header=True)
    parts = files.file_inventory(spark, path).where("size > 0").first()
    maps = files.read_header_map(spark, parts.path)
    return maps.select(
        F.col("attributes")["n_nationkey"].alias("line"),
        F.explode("attributes").alias("attribute", "value"),
    )


@query
def read_header_map_objects(spark, sf_dir):
    """Nations and regions as text objects in one folder, each with a header of its own."""
    path = scratch_path(spark, "objects")
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    for df in (nations.select("n_nationkey", "n_name"), regions.select("r_name", "r_regionkey")):
        df.coalesce(1).write.mode("append").csv(path, header=True)
    maps = files.read_header_map(spark, path)
    key = F.coalesce(F.col("attributes")["n_nationkey"], F.col("attributes")["r_regionkey"])
    return maps.select(key.alias("line"), F.explode("attributes").alias("attribute", "value"))


# Step SQL


def step_sql(spark, sf_dir, names, sql):
    views(spark, sf_dir, *names)
    return sql_step(spark, Step("t", sql))


@query
def sql_step_join_agg(spark, sf_dir):
    return step_sql(
        spark,
        sf_dir,
        ["customer", "orders", "nation"],
        "SELECT n_name, count(*) AS n_orders, "
        "sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents "
        "FROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    )


@query
def sql_step_semi_anti(spark, sf_dir):
    return step_sql(
        spark,
        sf_dir,
        ["customer", "orders"],
        "SELECT c_custkey, true AS has_orders FROM customer "
        "LEFT SEMI JOIN orders ON o_custkey = c_custkey UNION ALL "
        "SELECT c_custkey, false FROM customer LEFT ANTI JOIN orders ON o_custkey = c_custkey",
    )


@query
def sql_step_outer_join(spark, sf_dir):
    return step_sql(
        spark,
        sf_dir,
        ["customer", "supplier", "nation"],
        "SELECT n_name, n_customers, n_suppliers FROM "
        "(SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY 1) c "
        "FULL JOIN (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1) s "
        "ON c_nationkey = s_nationkey "
        "RIGHT JOIN nation ON n_nationkey = coalesce(c_nationkey, s_nationkey)",
    )


@query
def sql_step_window_topk(spark, sf_dir):
    return step_sql(
        spark,
        sf_dir,
        ["orders"],
        "SELECT o_custkey, o_orderkey, place FROM (SELECT o_custkey, o_orderkey, row_number() "
        "OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place "
        "FROM orders) WHERE place <= 3",
    )


@query
def sql_step_setops(spark, sf_dir):
    return step_sql(
        spark,
        sf_dir,
        ["customer", "supplier"],
        "SELECT 'union' AS op, k FROM (SELECT c_nationkey AS k FROM customer "
        "UNION SELECT s_nationkey FROM supplier) UNION ALL "
        "SELECT 'intersect', k FROM (SELECT c_nationkey AS k FROM customer "
        "INTERSECT SELECT s_nationkey FROM supplier) UNION ALL "
        "SELECT 'except', k FROM (SELECT c_custkey AS k FROM customer "
        "EXCEPT SELECT s_suppkey FROM supplier)",
    )


@query
def sql_step_rollup(spark, sf_dir):
    return step_sql(
        spark,
        sf_dir,
        ["lineitem"],
        "SELECT l_returnflag, l_linestatus, grouping_id(l_returnflag, l_linestatus) AS level, "
        "count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS quantity "
        "FROM lineitem GROUP BY ROLLUP(l_returnflag, l_linestatus)",
    )


# Columns


@query
def cast_id_columns_query(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("Line_Id"),
        F.col("l_extendedprice").alias("price_id"),
        F.col("l_discount").cast("decimal(6,2)").alias("discount_ID"),
        (F.col("l_quantity") > 25).alias("large_id"),
        F.col("l_returnflag").alias("flag_id"),
        F.col("l_quantity").alias("quantity"),
    )
    return cast_id_columns(df)


@query
def derived_pre_post(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return derive_columns(
        orders,
        pre=[
            DerivedColumn("o_orderkey * 10 + o_custkey", "mixed"),
            DerivedColumn("lower(o_orderstatus)", "status"),
        ],
        post=[DerivedColumn("concat_ws('-', o_orderstatus, o_custkey)", "label")],
    )


@query
def derived_assemble(spark, sf_dir):
    """The order of the columns: before, source, after."""
    shown = derived_pre_post(spark, sf_dir)
    places = F.array(*(F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"))
                       for i, c in enumerate(shown.columns)))
    placed = shown.select(F.explode(places).alias("p")).select("p.c", "p.i")
    return placed.groupBy(F.col("c").alias("column"), F.col("i").alias("place")).agg(
        F.count("*").alias("n")
    )


@query
def derived_param(spark, sf_dir):
    step = Step(
        "t",
        "SELECT o_orderkey, o_custkey AS cust_id FROM orders",
        pre=(DerivedColumn("CAST(batchId AS LONG)", "run_id", "param", "batchId"),),
        post=(DerivedColumn("'jobName'", "job", "PARAM".lower(), "jobName"),),
    )
    views(spark, sf_dir, "orders")
    return step_output(spark, step, {"batchId": "20210502120001", "jobName": "nightly"})


@query
def json_attr_query(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        json_attr("props", "k").alias("k"),
        json_attr("props", "$.k").alias("same"),
        json_attr("props", "absent.path").alias("absent"),
    )


@query
def json_nodes_query(spark, sf_dir):
    """Arrays of objects, a lone object, bare values, an empty and an absent list."""
    text = F.expr(
        """CASE event_type
        WHEN 'click' THEN concat('{"list": [', props, ', ', props, ']}')
        WHEN 'view' THEN concat('{"list": ', props, '}')
        WHEN 'purchase' THEN concat('{"list": [', event_id, ', "', event_type, '"]}')
        WHEN 'signup' THEN '{"list": []}' ELSE props END"""
    )
    nodes = json_nodes(table(spark, sf_dir, "events").withColumn("doc", text), "doc", "list")
    return nodes.select(
        "event_id", json_attr("node", "k").alias("k"), json_attr("node", "value").alias("value")
    )


# Lookups


def supplier_lookup(spark, sf_dir, limit=None, way=""):
    spec = LookupSpec(
        "suppliers", "id", f"{sf_dir}/supplier.parquet", "SELECT s_suppkey, s_name FROM suppliers"
    )
    return L.build_lookup(spark, spec, limit, way)


def priority_lookup(spark, sf_dir, limit=None, way=""):
    spec = LookupSpec(
        "priorities",
        "User",
        f"{sf_dir}/orders.parquet",
        "SELECT o_orderpriority, lower(substr(o_orderpriority, 3)) FROM priorities",
    )
    return L.build_lookup(spark, spec, limit, way)


def line_codes(spark, sf_dir):
    """Lines with a cell of two codes; only some part keys are supplier keys."""
    cell = F.concat_ws(",", F.lit(""), "l_suppkey", "l_partkey", F.lit(""))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cell.alias("codes"))


def order_codes(spark, sf_dir):
    cell = F.concat_ws("|", "o_orderpriority", "o_orderstatus", "o_orderpriority")
    return table(spark, sf_dir, "orders").select("o_orderkey", cell.alias("codes"))


@query
def lookup_by_id(spark, sf_dir):
    lookup = supplier_lookup(spark, sf_dir)
    return L.lookup_by_id(line_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA", "names")


@query
def lookup_by_id_joined(spark, sf_dir):
    lookup = supplier_lookup(spark, sf_dir, way="joined")
    return L.lookup_by_id(line_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA", "names")


@query
def lookup_by_id_sharded(spark, sf_dir):
    lookup = supplier_lookup(spark, sf_dir, LARGE)
    return L.lookup_by_id(line_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA", "names")


@query
def lookup_by_user(spark, sf_dir):
    lookup = priority_lookup(spark, sf_dir)
    return L.lookup_by_user(order_codes(spark, sf_dir), "codes", lookup, r"\|", "+", "?", "labels")


@query
def lookup_by_user_joined(spark, sf_dir):
    lookup = priority_lookup(spark, sf_dir, way="joined")
    return L.lookup_by_user(order_codes(spark, sf_dir), "codes", lookup, r"\|", "+", "?", "labels")


@query
def lookup_by_user_sharded(spark, sf_dir):
    lookup = priority_lookup(spark, sf_dir, LARGE)
    return L.lookup_by_user(order_codes(spark, sf_dir), "codes", lookup, r"\|", "+", "?", "labels")


@query
def lookup_null_no_match(spark, sf_dir):
    lookup = supplier_lookup(spark, sf_dir)
    return L.lookup_by_id(line_codes(spark, sf_dir), "codes", lookup, ",", ";", None, "names")


def by_sql(spark, sf_dir, limit):
    suppliers, priorities = (f(spark, sf_dir, limit) for f in (supplier_lookup, priority_lookup))
    L.register_sql_functions(spark, [suppliers, priorities])
    views(spark, sf_dir, "lineitem", "orders")
    step = Step(
        "t",
        "SELECT l_orderkey, l_linenumber, l_suppkey, o_orderpriority, "
        "concat_ws(',', '', l_suppkey, l_partkey, '') AS codes "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
        pre=(
            DerivedColumn("lookupValueByIdList('suppliers', codes, ',', ';', 'NA')", "names"),
            DerivedColumn("lookupValueByIdList('suppliers', l_suppkey, ',', ';', 'NA')", "name"),
        ),
        post=(
            DerivedColumn(
                "lookupValueByUserList('priorities', o_orderpriority, ',', ';', 'NA')", "priority"
            ),
        ),
    )
    return step_output(spark, step, {})


@query
def lookup_sql_functions(spark, sf_dir):
    return by_sql(spark, sf_dir, None)


@query
def lookup_sql_functions_joined(spark, sf_dir):
    return by_sql(spark, sf_dir, LARGE)


def in_clause(name: str, sql: str):
    """Queries that call a lookup function in a clause, below and above the limit."""

    def below(spark, sf_dir):
        return asked(spark, sf_dir, None)

    def above(spark, sf_dir):
        return asked(spark, sf_dir, LARGE)

    def asked(spark, sf_dir, limit):
        lookups = (f(spark, sf_dir, limit) for f in (supplier_lookup, priority_lookup))
        L.register_sql_functions(spark, lookups)
        views(spark, sf_dir, "lineitem", "orders", "supplier")
        edge_codes(spark, sf_dir).createOrReplaceTempView("edge_codes")
        return spark.sql(sql)

    below.__name__, above.__name__ = name, f"{name}_joined"
    query(below)
    query(above)


in_clause(
    "lookup_sql_order_by",
    "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem ORDER BY "
    "lookupValueByIdList('suppliers', concat_ws(',', l_suppkey, l_partkey), ',', ';', 'NA') DESC, "
    "l_orderkey, l_linenumber LIMIT 500",
)
in_clause(
    "lookup_sql_explode",
    "SELECT l_orderkey, l_linenumber, position, name FROM lineitem LATERAL VIEW posexplode(split("
    "lookupValueByIdList('suppliers', concat_ws(',', l_suppkey, l_partkey), ',', ';', 'NA'), ';'"
    ")) AS position, name",
)
in_clause(
    "lookup_sql_join_on",
    "SELECT l_orderkey, l_linenumber, s_suppkey, o_orderpriority FROM lineitem JOIN supplier "
    "ON lookupValueByIdList('suppliers', l_suppkey, ',', ';', 'NA') = s_name JOIN orders "
    "ON l_orderkey = o_orderkey AND "
    "lookupValueByUserList('priorities', o_orderpriority, ',', ';', '?') <> 'low'",
)
in_clause(
    "lookup_sql_edge_cases",
    "SELECT l_orderkey, l_linenumber, "
    "lookupValueByIdList('suppliers', codes, ',', ';', 'NA') AS names FROM edge_codes",
)


def edge_codes(spark, sf_dir):
    """Each line gets a cell whose form depends on its line number."""
    views(spark, sf_dir, "lineitem")
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' "
        "WHEN 3 THEN ',' WHEN 4 THEN concat('\t,', l_suppkey, ',,', l_partkey, ', ') "
        "WHEN 5 THEN concat(' ', l_suppkey, ' ,', l_suppkey, '.9,', l_suppkey, 'e0') "
        "WHEN 6 THEN concat('x,-1', l_suppkey, ',', l_partkey, 'd') "
        "ELSE concat(l_partkey, ',', l_suppkey, ',', l_partkey) END AS codes FROM lineitem"
    )


@query
def lookup_edge_cases(spark, sf_dir):
    lookup = supplier_lookup(spark, sf_dir)
    df = L.lookup_by_id(edge_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA", "names")
    return df.drop("codes")


@query
def lookup_edge_cases_joined(spark, sf_dir):
    lookup = supplier_lookup(spark, sf_dir, way="joined")
    df = L.lookup_by_id(edge_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA", "names")
    return df.drop("codes")


@query
def lookup_edge_cases_sharded(spark, sf_dir):
    lookup = supplier_lookup(spark, sf_dir, LARGE)
    df = L.lookup_by_id(edge_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA", "names")
    return df.drop("codes")


@query
def lookup_wrong_kind(spark, sf_dir):
    L.register_sql_functions(
        spark, [supplier_lookup(spark, sf_dir), priority_lookup(spark, sf_dir)]
    )
    views(spark, sf_dir, "lineitem")
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, "
        "lookupValueByIdList('priorities', concat(l_suppkey, ',', l_partkey), ',', ';', 'NA') "
        "AS by_id, lookupValueByUserList('suppliers', l_suppkey, ',', ';', 'NA') AS by_user "
        "FROM lineitem"
    )


@query
def lookup_build(spark, sf_dir):
    """A key given many times keeps its greatest label."""
    spec = LookupSpec(
        "users", "id", f"{sf_dir}/events.parquet", "SELECT user_id, event_type FROM users"
    )
    return L.build_lookup(spark, spec).frame


@query
def lookup_size(spark, sf_dir):
    lookup = priority_lookup(spark, sf_dir)
    return lookup.frame.agg(
        F.lit(lookup.name).alias("name"),
        F.count("*").alias("counted"),
        F.lit(lookup.rows).alias("reported"),
    )


@query
def lookup_dedupe(spark, sf_dir):
    """Two steps that share a lookup build it once; another kind builds nothing."""
    path, sql = f"{sf_dir}/customer.parquet", "SELECT c_custkey, c_name FROM named"
    spec = LookupSpec("named", "id", path, sql)
    steps = (
        Step("a", "", "object", lookups=(spec,)),
        Step("b", "", "object", lookups=(spec, LookupSpec("named", "none", path, sql))),
    )
    built = [L.build_lookup(spark, s) for s in job(steps=steps).lookups()]
    known = [b for b in built if b is not None]
    return known[0].frame.agg(
        F.count("*").alias("n_keys"), F.lit(len(built)).alias("specs"),
        F.lit(len(known)).alias("lookups"),
    )


# Publication


@query
def distinct_effective_keys(spark, sf_dir):
    return publish.distinct_effective_keys(daily_events(spark, sf_dir))


@query
def write_append(spark, sf_dir):
    path = scratch_path(spark, "appended")
    customers = table(spark, sf_dir, "customer")
    for _ in range(2):
        publish.write_append(customers, path, files=3)
    return spark.read.parquet(path).groupBy("c_custkey").agg(F.count("*").alias("n"))


@query
def write_append_partitioned(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    publish.write_append(table(spark, sf_dir, "customer"), path, ["c_mktsegment", "c_nationkey"])
    return spark.read.parquet(path).select("c_custkey", "c_mktsegment", "c_nationkey")


@query
def append_union(spark, sf_dir):
    """Rows with other columns appended to a dataset, read merged."""
    path = scratch_path(spark, "union")
    publish.write_append(
        table(spark, sf_dir, "customer").select(
            F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        ),
        path,
    )
    publish.write_append(
        table(spark, sf_dir, "supplier").select(
            F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
        ),
        path,
    )
    return parquet.scan_parquet_merged(spark, path).select("name", "segment", "nation")


def republished(spark, sf_dir, partition_columns, later):
    """All events published, then those of ``later``; what is read back."""
    path = scratch_path(spark, "events")
    events = daily_events(spark, sf_dir).withColumn("version", F.lit(1))
    publish.replace_by_key(events, path, partition_columns)
    publish.replace_by_key(later(events).withColumn("version", F.lit(2)), path, partition_columns)
    return versions(spark, path)


def versions(spark, path):
    return spark.read.parquet(path).select(
        "event_id", "event_type", "version", F.col(EFFECTIVE_KEY).cast("bigint").alias("bet")
    )


@query
def replace_by_key(spark, sf_dir):
    days = F.col(EFFECTIVE_KEY).between(20240110120000, 20240112120000)
    return republished(spark, sf_dir, [EFFECTIVE_KEY], lambda events: events.where(days))


@query
def replace_by_key_subpartitions(spark, sf_dir):
    """Days published again without one type: that type is gone from those days."""
    days = F.col(EFFECTIVE_KEY).between(20240110120000, 20240112120000)
    fewer = days & (F.col("event_type") != "click")
    return republished(
        spark, sf_dir, [EFFECTIVE_KEY, "event_type"], lambda events: events.where(fewer)
    )


@query
def replace_by_key_unpartitioned(spark, sf_dir):
    """Without the key among the partitions nothing is replaced: a re-run appends."""
    path = scratch_path(spark, "by_type")
    events = daily_events(spark, sf_dir)
    for columns in (["event_type"], ["event_type"]):
        publish.replace_by_key(events, path, columns)
    return spark.read.parquet(path).groupBy("event_type", EFFECTIVE_KEY).agg(F.count("*").alias("n"))


@query
def replace_by_key_after_a_crash(spark, sf_dir):
    """A run that ended after its record and before the swap is finished by the next one."""
    path, columns = scratch_path(spark, "events"), [EFFECTIVE_KEY, "event_type"]
    events = daily_events(spark, sf_dir).withColumn("version", F.lit(1))
    publish.replace_by_key(events, path, columns)
    fewer = F.col(EFFECTIVE_KEY).between(20240110120000, 20240112120000)
    fewer &= F.col("event_type") != "click"
    publish.stage(events.where(fewer).withColumn("version", F.lit(2)), path, columns, replace=True)
    publish.finish_intents(spark, path)
    return versions(spark, path)


@query
def replace_by_key_rerun(spark, sf_dir):
    """The whole output published twice is there once."""
    return republished(spark, sf_dir, ["event_type", EFFECTIVE_KEY], lambda events: events)


def segment_table(spark, sf_dir):
    name, path = f"default.customers_{uuid.uuid4().hex}", scratch_path(spark, "segments")
    customers = table(spark, sf_dir, "customer")
    publish.write_append(customers.where("c_nationkey < 12"), path, ["c_mktsegment"])
    create_external_table(spark, name, customers.schema, path, ["c_mktsegment"])
    publish.write_append(customers.where("c_nationkey >= 12"), path, ["c_mktsegment"])
    repair_partitions(spark, name)
    spark.catalog.refreshTable(name)
    return name


@query
def external_table_roundtrip(spark, sf_dir):
    return spark.table(segment_table(spark, sf_dir))


@query
def repair_partitions_query(spark, sf_dir):
    return spark.sql(f"SHOW PARTITIONS {segment_table(spark, sf_dir)}")


@query
def catalog_type_names(spark, sf_dir):
    """A BIGINT column, and a timestamp partition that the catalog keeps as text."""
    name, path = f"default.typed_{uuid.uuid4().hex}", scratch_path(spark, "typed")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_trunc("year", "o_orderdate").alias("o_year")
    )
    publish.write_append(orders, path, ["o_year"])
    create_external_table(spark, name, orders.schema, path, ["o_year"])
    return spark.table(name).select(
        "o_orderkey",
        "o_year",
        *(F.typeof(c).alias(f"type_{i}") for i, c in enumerate(orders.columns)),
    )


@query
def write_partition_count(spark, sf_dir):
    """At least the configured number of files; adaptive execution may make it more."""
    path = scratch_path(spark, "counted")
    publish.write_append(table(spark, sf_dir, "orders"), path, files=write_files("3"))
    return spark.read.parquet(path).agg(
        F.count("*").alias("n_rows"), (F.count_distinct("_metadata.file_path") >= 3).alias("enough")
    )


# Whole jobs


def source_node(sf_dir, name, **more):
    return {"sourcePath": f"{sf_dir}/{name}.parquet", "viewName": name, **more}


def job_config(spark, sf_dir):
    """Two steps: orders with decoded names, and event counts per day."""
    mark = uuid.uuid4().hex
    return {
        "projectName": "catalogue",
        "basePath": scratch_path(spark, "job"),
        "projectDB": "default",
        "jobLogTableName": f"job_log_{mark}",
        "jobType": "full",
        "stepList": [
            {
                "stepType": STEP_TYPE,
                "stepCategory": "object",
                "hiveTableName": f"orders_{mark}",
                "numOfWriteRepartition": "8",
                "sourceJoinTableList": [
                    source_node(sf_dir, "customer"),
                    source_node(sf_dir, "orders", cacheFlag="false"),
                    source_node(sf_dir, "nation"),
                ],
                "sourceJoinSQL": "SELECT o_orderkey AS order_id, CAST(c_custkey AS DOUBLE) AS "
                "customer_id, n_name, o_orderstatus AS status, "
                "concat(',', c_custkey, ',', o_orderkey, ',') AS codes, "
                "CAST(date_format(o_orderdate, 'yyyyMM01120000') AS BIGINT) AS "
                f"{EFFECTIVE_KEY} FROM orders JOIN customer ON o_custkey = c_custkey "
                "JOIN nation ON c_nationkey = n_nationkey",
                "lookupList": [
                    {
                        "lookupListName": "customer_names",
                        "lookupListType": "id",
                        "lookupListSourcePath": f"{sf_dir}/customer.parquet",
                        "lookupListSourceSQL": "SELECT c_custkey, c_name FROM customer_names",
                    },
                    {
                        "lookupListName": "statuses",
                        "lookupListType": "user",
                        "lookupListSourcePath": f"{sf_dir}/orders.parquet",
                        "lookupListSourceSQL": "SELECT o_orderstatus, concat('status ', "
                        "o_orderstatus) FROM statuses",
                    },
                ],
                "partitionColumnList": [EFFECTIVE_KEY],
                "preDerivedColumnList": [
                    {
                        "colExpression": "CAST(batchId AS LONG)",
                        "colSource": "param",
                        "colSourceExpression": "batchId",
                        "colAlias": "run_id",
                    }
                ],
                "postDerivedColumnList": [
                    {
                        "colExpression": "lookupValueByIdList('customer_names', codes, ',', ';', "
                        "'none')",
                        "colAlias": "names",
                    },
                    {
                        "colExpression": "lookupValueByUserList('statuses', status, ',', ';', '')",
                        "colAlias": "status_label",
                    },
                ],
            },
            {
                "stepType": STEP_TYPE,
                "stepCategory": "relationship",
                "hiveTableName": f"event_days_{mark}",
                "sourceJoinTableList": [source_node(sf_dir, "events")],
                "sourceJoinSQL": "SELECT event_type, count(*) AS n_events, "
                "count(DISTINCT user_id) AS n_users, CAST(concat(date_format(ts, 'yyyyMMdd'), "
                f"'120000') AS BIGINT) AS {EFFECTIVE_KEY} FROM events GROUP BY 1, 4",
                "partitionColumnList": [{"value": EFFECTIVE_KEY}, {"value": "event_type"}],
            },
        ],
    }


ARGUMENTS = {"jobName": "catalogue", "batchId": "20240102030405"}


@query
def run_job_query(spark, sf_dir):
    tables = run_job(spark, job_config(spark, sf_dir), ARGUMENTS)
    return spark.table(tables[0])


@query
def run_job_second_step(spark, sf_dir):
    tables = run_job(spark, job_config(spark, sf_dir), ARGUMENTS)
    return spark.table(tables[1])


@query
def run_job_daily(spark, sf_dir):
    """A daily job reads the newest snapshot of the sources that it lists."""
    name = f"newest_{uuid.uuid4().hex}"
    sql = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(date_format(o_orderdate, "
        f"'yyyyMM01120000') AS BIGINT) AS {EFFECTIVE_KEY} FROM snapshots"
    )
    config = small_config(spark, sf_dir, (STEP_TYPE, name, sql))
    config |= {"jobType": "DAILY", "sourceJoinSnapshotTablesList": "others, snapshots"}
    config["stepList"][0]["sourceJoinTableList"] = [
        {"sourcePath": order_snapshots(spark, sf_dir), "viewName": "snapshots"}
    ]
    return spark.table(run_job(spark, config, ARGUMENTS)[0])


@query
def run_job_historical(spark, sf_dir):
    """A historical job works on sources that are written anew for it."""
    config = job_config(spark, sf_dir) | {"jobType": "historical"}
    config["stepList"] = config["stepList"][1:]
    return spark.table(run_job(spark, config, ARGUMENTS)[0])


@query
def run_job_large_lookup(spark, sf_dir):
    """The same job where no lookup may be broadcast."""
    spark.conf.set(L.BROADCAST_SETTING, str(LARGE))
    try:
        return spark.table(run_job(spark, job_config(spark, sf_dir), ARGUMENTS)[0])
    finally:
        spark.conf.unset(L.BROADCAST_SETTING)


@query
def job_log_time(spark, sf_dir):
    """Every record of a job has a time in the log's format, in the order of writing."""
    config = job_config(spark, sf_dir)
    run_job(spark, config, ARGUMENTS)
    log = spark.table(config["jobLogTableName"])
    time = F.try_to_timestamp("time", F.lit("yyyy-MM-dd HH:mm:ss"))
    same = F.date_format(time, "yyyy-MM-dd HH:mm:ss") == F.col("time")
    return log.where("step = 'read sources'").select(
        F.regexp_extract("msg", "^[a-z]+", 0).alias("source"), F.coalesce(same, F.lit(False)).alias("same")
    )


@query
def job_log(spark, sf_dir):
    """The size of each lookup, as the job logged it."""
    config = job_config(spark, sf_dir)
    run_job(spark, config, ARGUMENTS)
    log = spark.table(config["jobLogTableName"]).where("step = 'build lookups'")
    return log.select("level", "step", "msg", "job_name", "batch_id")


def small_config(spark, sf_dir, *steps):
    """A job of steps given as (type, table, SQL over the customers)."""
    return {
        "basePath": scratch_path(spark, "job"),
        "projectDB": "default",
        "jobLogTableName": f"job_log_{uuid.uuid4().hex}",
        "stepList": [
            {
                "stepType": kind,
                "stepCategory": "relationship",
                "hiveTableName": name,
                "sourceJoinTableList": [source_node(sf_dir, "customer")],
                "sourceJoinSQL": sql,
                "partitionColumnList": [EFFECTIVE_KEY],
            }
            for kind, name, sql in steps
        ],
    }


CUSTOMER_STEP = f"SELECT c_custkey, c_name, 20240101120000 AS {EFFECTIVE_KEY} FROM customer"


@query
def step_filter(spark, sf_dir):
    """Steps of another type are left out."""
    done, ignored = (f"{word}_{uuid.uuid4().hex}" for word in ("done", "ignored"))
    config = small_config(
        spark, sf_dir, (STEP_TYPE.upper(), done, CUSTOMER_STEP), ("ingestion", ignored, "no SQL")
    )
    tables = run_job(spark, config, ARGUMENTS)
    return spark.table(tables[0]).agg(
        F.count("*").alias("n_rows"),
        F.lit(parquet.table_exists(spark, f"default.{done}")).alias("done_exists"),
        F.lit(parquet.table_exists(spark, f"default.{ignored}")).alias("ignored_exists"),
    )


@query
def fail_fast(spark, sf_dir):
    """After a step that fails nothing starts; what was published and logged stays."""
    names = [f"{word}_{uuid.uuid4().hex}" for word in ("good", "bad", "late")]
    sqls = [CUSTOMER_STEP, CUSTOMER_STEP.replace("c_name", "no_such_column"), CUSTOMER_STEP]
    config = small_config(
        spark, sf_dir, *((STEP_TYPE, n, q) for n, q in zip(names, sqls, strict=True))
    )
    try:
        run_job(spark, config, ARGUMENTS)
    except StepFailed as error:
        stage = error.stage
    log = parquet.scan_parquet_merged(spark, f"{config['basePath']}/{config['jobLogTableName']}")
    errors = log.where("level = 'ERROR'").agg(F.count("*").alias("n_errors"))
    late = parquet.table_exists(spark, f"default.{names[2]}")
    return spark.table(names[0]).agg(
        F.count("*").alias("n_rows"),
        F.lit(stage).alias("stage"),
        F.lit(late).alias("late_exists"),
        F.lit(errors.first().n_errors).cast("bigint").alias("n_errors"),
    )


# The operator's own name where the function could not have it.
for _name in ("cast_id_columns", "json_attr", "json_nodes", "repair_partitions", "run_job"):
    QUERIES[_name] = QUERIES.pop(f"{_name}_query")
