"""Physical-plan checks: pushdown, pruning, aggregate-before-join, top-k, no cross join."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from salesmart.operators import marts
from salesmart.plans.queries import REGISTRY
from salesmart.sources import testdata as td

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shuffles(tree: str) -> int:
    return sum(1 for line in tree.splitlines() if re.search(r"[-:] Exchange \(", line))


def test_range_filter_is_pushed_to_parquet(spark):
    p = plan(td.orders(spark, SF).filter(F.col("order_id") <= 12))
    assert "LessThanOrEqual(o_orderkey,12)" in p


def test_only_needed_columns_are_read(spark):
    p = plan(REGISTRY["q_sales_by_day"](spark, SF))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


def test_product_mart_aggregates_before_the_join(spark):
    p = plan(REGISTRY["q_sales_by_product"](spark, SF))
    head = p.split("\n\n")[0]
    join_line = next(i for i, line in enumerate(head.splitlines()) if "Join" in line)
    partial_lines = [i for i, line in enumerate(head.splitlines()) if "HashAggregate" in line]
    assert any(i > join_line for i in partial_lines), head  # an aggregate below the join
    # One shuffle (the fact side's partial aggregate); the second aggregate reuses it.
    assert shuffles(head) == 1, head


def test_category_filter_reaches_the_dimension_scan(spark):
    p = plan(REGISTRY["q_sales_by_product_in_category"](spark, SF))
    assert "EqualTo(p_type,ECONOMY)" in p


def test_preview_is_a_bounded_top_k(spark):
    assert "TakeOrderedAndProject" in plan(REGISTRY["q_order_preview"](spark, SF))


def test_share_uses_no_cross_join(spark):
    p = plan(REGISTRY["q_sales_by_hour"](spark, SF))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_keyed_repartition_is_reused_by_the_aggregate(spark):
    p = plan(REGISTRY["q_keyed_partition_sales"](spark, SF))
    tree = p.split("\n\n")[0]
    assert shuffles(tree) == 1, tree  # the keyed shuffle, which the aggregate per product reuses


def test_bounded_hint_broadcasts(spark):
    assert "BroadcastHashJoin" in plan(REGISTRY["q_broadcast_join_sales"](spark, SF))


def test_count_and_sum_run_partial_shuffle_final(spark):
    from salesmart.operators import partitions

    text = partitions.explain_text(marts.key_summary(td.order_lines(spark, SF)))
    assert "partial_count(1)" in text and "partial_sum" in text
    assert "hashpartitioning(product_id" in text
    assert "Functions [2]: [count(1), sum(amount" in text


def test_day_literal_becomes_a_pushed_timestamp_range(spark):
    p = plan(REGISTRY["q_orders_on_day"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate," in p and "LessThan(o_orderdate," in p


def test_inner_join_adds_null_key_filter(spark):
    p = plan(REGISTRY["q_enriched_orders"](spark, SF))
    assert "IsNotNull(l_partkey)" in p and "IsNotNull(p_partkey)" in p


def test_no_registered_plan_uses_python_udfs_or_cross_joins(spark):
    """Every registered query stays JVM-side and has no cross / nested-loop join."""
    banned = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
              "CartesianProduct", "BroadcastNestedLoopJoin")
    written = {"q_batch_products", "q_dashboard_rows", "q_refresh_counts", "q_refresh_products", "q_section_sizes",
               "q_incremental_periods", "q_incremental_products"}  # scans of what a batch wrote
    for name, fn in REGISTRY.items():
        if name in written:
            continue
        text = plan(fn(spark, SF))
        found = [b for b in banned if b in text]
        assert not found, (name, found)
