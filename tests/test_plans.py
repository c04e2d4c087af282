"""Plan properties that must hold at any scale (checked with size-based
auto-broadcast off, as Spark would plan for very large tables)."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin",
             # stay JVM-side: no Python UDF evaluation in any query plan
             "BatchEvalPython", "ArrowEvalPython"]


@pytest.fixture(scope="module")
def large_table_settings(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(q for q in entry.queries() if q.startswith("q_")))
def test_no_cross_products_or_python_udfs(spark, large_table_settings, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_scans_prune_columns_and_push_filters(spark, large_table_settings):
    df = entry.queries()["q_payments_by_order"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan      # payments are all of lineitem
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_returnflag:string" in plan
    for unused in ("l_partkey", "l_suppkey", "l_discount", "l_tax", "l_shipdate"):
        assert unused not in plan


def test_fact_joins_reuse_order_partitioning(spark, large_table_settings):
    plan = entry.queries()["q_fct_orders"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2
    # orders, items and payments by order; payments are first summed per (order, type)
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", plan)) == 3
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, payment_type#\d+, \d+\)", plan)) == 1
    assert plan.count("BroadcastExchange") == 1                    # the size-checked rate calendar


@pytest.mark.parametrize("name", ["q_items_by_order", "q_payments_by_order", "q_test_unique_combo",
                                  "q_test_relationships", "q_dead_runs", "q_test_accepted_values"])
def test_keyed_work_combines_map_side(spark, large_table_settings, name):
    """A hot key must be pre-aggregated in every task before the shuffle."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert exchanges
    for i in exchanges:   # the operator feeding every shuffle is a (partial) aggregate
        assert "Aggregate" in lines[i + 1], f"{name}: shuffle not fed by an aggregate: {lines[i + 1]}"


def test_join_small_falls_back_to_a_shuffle_beyond_its_bounds(spark, large_table_settings):
    from sluice.operators.joins import join_small

    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(100).withColumnRenamed("id", "k")
    within = join_small(big, small, "k", "inner")
    beyond_rows = join_small(big, small, "k", "inner", max_rows=10)
    beyond_bytes = join_small(big, small, "k", "inner", max_bytes=10)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan(within)
    for df in (beyond_rows, beyond_bytes):
        assert "BroadcastExchange" not in plan(df) and "SortMergeJoin" in plan(df)
    assert within.count() == beyond_rows.count() == beyond_bytes.count() == 100
