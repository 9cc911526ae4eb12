"""What the plans must look like to hold at scale."""

from catalogue import queries as Q
from stepweave.operators import lookups as L
from stepweave.operators import publish
from stepweave.session import scratch_path
from stepweave.sources import parquet


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_indexed_lookup_has_no_exchange_and_reads_only_what_it_needs(spark, sf_dir):
    out = L.lookup_by_id(
        Q.line_codes(spark, sf_dir), "codes", Q.supplier_lookup(spark, sf_dir), ",", ";", "NA"
    )
    plan = _plan(out)
    assert "Exchange" not in plan and "ArrowEvalPython" in plan
    assert plan.count("FileScan") == 1
    assert "l_comment" not in plan and "l_extendedprice" not in plan


def test_indexed_lookup_splits_a_cell_once(spark, sf_dir):
    out = L.lookup_by_user(
        Q.order_codes(spark, sf_dir), "codes", Q.priority_lookup(spark, sf_dir), r"\|", "+", "?"
    )
    assert _plan(out).count("split(") == 1


def test_joined_lookup_never_makes_a_cartesian_product(spark, sf_dir):
    lookup = Q.supplier_lookup(spark, sf_dir, way="joined")
    plan = _plan(L.lookup_by_id(Q.line_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA"))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "[l_orderkey" in plan


def test_large_lookup_is_probed_where_the_facts_lie(spark, sf_dir):
    lookup = Q.supplier_lookup(spark, sf_dir, Q.LARGE)
    assert lookup.way == "sharded"
    plan = _plan(L.lookup_by_id(Q.line_codes(spark, sf_dir), "codes", lookup, ",", ";", "NA"))
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_lookup_functions_are_planned_alike_at_every_size(spark, sf_dir):
    plans = [
        _plan(Q.QUERIES[name](spark, sf_dir))
        for name in ("lookup_sql_functions", "lookup_sql_functions_joined")
    ]
    for plan in plans:
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert plan.count("ArrowEvalPython") == 1  # all calls in one pass
    assert plans[0].count("Exchange") == plans[1].count("Exchange")
    plan = _plan(Q.QUERIES["lookup_sql_join_on_joined"](spark, sf_dir))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_newest_snapshot_reads_one_folder(spark, sf_dir):
    path = Q.order_snapshots(spark, sf_dir)
    files = parquet.scan_latest_snapshot(spark, path).inputFiles()
    newest = parquet.latest_snapshot(spark, path)
    assert files and all(f"batch_id={newest}" in f for f in files)


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    Q.views(spark, sf_dir, "lineitem")
    df = spark.sql("SELECT l_orderkey AS line_id FROM lineitem WHERE l_suppkey = 3")
    plan = _plan(Q.cast_id_columns(df))
    assert "EqualTo(l_suppkey,3)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan


def test_top_rows_are_cut_before_the_exchange(spark, sf_dir):
    assert "WindowGroupLimit" in _plan(Q.QUERIES["sql_step_window_topk"](spark, sf_dir))


def test_publication_computes_the_output_once(spark, sf_dir):
    """One pass: the counter sees every row once, null check and report included."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    events = Q.daily_events(spark, sf_dir)
    rows = events.count()
    counted = events.mapInArrow(count, events.schema)
    path = scratch_path(spark, "once")
    publish.replace_by_key(counted, path, [publish.EFFECTIVE_KEY, "event_type"])
    assert seen.value == rows == spark.read.parquet(path).count()
