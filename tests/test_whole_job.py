"""Queries on own rows: whole input, and dimensions of any size."""

import datetime

from salesmart.operators import joins, marts
from salesmart.plans.queries import REGISTRY
from tests.test_plans import plan


def test_daily_revenue_counts_every_order(spark, scratch):
    day = datetime.datetime(1995, 6, 1, 12)
    rows = [(k, 1, 10.25, day) for k in (1, 2, 9, 10)] + [(8, 1, 1.0, day + datetime.timedelta(days=1)), (None, 1, 2.0, day)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{scratch}/orders.parquet")
    got = {r.order_date: r.revenue for r in REGISTRY["q_sample_sales_by_day"](spark, scratch).collect()}
    assert got == {"1995-06-01": 4300, "1995-06-02": 100}


def test_broadcast_join_beyond_its_bound_has_the_same_rows(spark):
    totals = spark.createDataFrame([(1, 5), (2, 7), (None, 9), (4, 1)], "product_id long, revenue long")
    dim = spark.createDataFrame([(1, "a"), (1, "again"), (2, None), (3, "c"), (None, "n")], "product_id long, name string")
    near, far = joins.broadcast_join(totals, dim, "product_id"), joins.broadcast_join(totals, dim, "product_id", max_bytes=10)
    assert "BroadcastHashJoin" in plan(near) and "SortMergeJoin" in plan(far)
    want = [(1, 5, "a"), (1, 5, "again"), (2, 7, None)]
    assert sorted(map(tuple, near.collect()), key=str) == sorted(map(tuple, far.collect()), key=str) == want


def test_product_mart_with_a_large_dimension(spark):
    totals = spark.range(70).selectExpr("id AS product_id", "2L AS order_count", "6L AS revenue", "3L AS sold_quantity")
    products = spark.range(71).selectExpr("id AS product_id", "concat(id, repeat('x', 1048576)) AS name", "'c' AS category")
    mart = marts.sales_by_product_from_totals(totals, products, broadcast_products=True)
    assert mart.selectExpr("count(*)", "sum(revenue)", "sum(length(product_name))").first() == (70, 420, 70 * (1 << 20) + 130)
