"""Map-reduce walk-throughs, partition invariance, join-strategy equivalence, generator."""

import pytest
from pyspark.sql import functions as F

from salesmart.functions.refine import refine_orders
from salesmart.operators import joins, marts, partitions
from salesmart.operators.ranking import with_rank
from salesmart.sources import synth
from tests.fixtures import TOTAL, orders_frame, products_frame

PAIRS = [("north", 12), ("south", 7), ("north", 30), ("east", 5), ("south", 11), ("north", 18), ("south", 3)]


def pairs(spark):
    return spark.createDataFrame(PAIRS, "product_id string, amount long").repartition(2)


def test_count_sum_and_average_per_key(spark):
    got = {r.product_id: (r.order_count, r.revenue, r.average_order_amount) for r in marts.key_summary(pairs(spark)).collect()}
    assert got == {"north": (3, 60, 20.0), "south": (3, 21, 7.0), "east": (1, 5, 5.0)}


def test_repartition_and_coalesce_keep_revenue(spark):
    orders = orders_frame(spark)
    base = sorted(marts.revenue_by_product(orders).collect())
    assert sorted(marts.revenue_by_product(partitions.round_robin(orders, 4)).collect()) == base
    assert sorted(marts.revenue_by_product(partitions.merged(orders, 2)).collect()) == base
    assert partitions.partition_count(partitions.merged(orders.repartition(6), 2)) == 2
    sizes = partitions.partition_sizes(partitions.round_robin(orders, 4)).collect()
    assert sum(r.rows for r in sizes) == 9 and len(sizes) <= 4


def test_keyed_partition_puts_each_key_in_one_partition(spark):
    keyed = partitions.keyed(orders_frame(spark), 4, "product_id")
    assert {r.partition_count for r in partitions.key_locality(keyed, "product_id").collect()} == {1}


def test_default_partition_counts_follow_the_data(spark):
    orders = orders_frame(spark).repartition(6)
    assert partitions.partition_count(partitions.merged(orders)) == 3
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions.partition_count(partitions.round_robin(orders)) == shuffle


def test_join_strategies_give_the_same_rows(spark):
    """A hinted join, one that splits hot keys, and a plain one."""
    orders, products = orders_frame(spark), products_frame(spark)
    plain = orders.join(products, "product_id")
    for other in (orders.join(joins.broadcast_bounded(products), "product_id"), marts.enrich(orders, products)):
        assert other.columns == plain.columns
        assert plain.exceptAll(other).count() == 0 and other.exceptAll(plain).count() == 0


def test_benchmark_rollup_has_one_total_row(spark):
    rows = partitions.benchmark_sales(orders_frame(spark)).collect()
    total = [r for r in rows if r.is_total == 1]
    assert len(total) == 1 and total[0].order_count == 9 and total[0].revenue == TOTAL
    assert sum(r.revenue for r in rows if r.is_total == 0) == TOTAL


def test_generator_closed_form_totals(spark):
    n = 1000
    orders = refine_orders(synth.orders(spark, n, num_partitions=4))
    assert orders.agg(F.sum("amount")).first()[0] == 18_500 * n // 10
    assert orders.agg(F.sum("quantity")).first()[0] == 3 * n
    per_product = {r.order_count for r in marts.product_totals(orders).collect()}
    assert per_product == {n // 100}
    cats = {r.category: (r.order_count, r.revenue) for r in marts.sales_by_category(orders, synth.products(spark)).collect()}
    assert {c: v[0] for c, v in cats.items()} == {f"분류 {k}": n // 5 for k in range(5)}
    # 70, 180, 330, 520 and 750 million per category at one million rows.
    assert [cats[f"분류 {k}"][1] for k in range(5)] == [x * n for x in (70, 180, 330, 520, 750)]


def test_generator_writes_raw_zone(spark, scratch):
    synth.write_raw(spark, 50, f"{scratch}/raw", num_partitions=2)
    from salesmart.sources import files

    assert files.read_orders_csv(spark, f"{scratch}/raw/orders.csv").count() == 50
    assert files.read_products_jsonl(spark, f"{scratch}/raw/products.jsonl").count() == 100


def test_broadcast_fails_beyond_its_bound(spark):
    products = products_frame(spark)
    assert joins.broadcast_bounded(products, max_bytes=10_000).count() == 5
    with pytest.raises(Exception, match="larger than the 100 bytes"):
        joins.broadcast_bounded(products, max_bytes=100).collect()


def test_duplicate_key_check(spark):
    products = products_frame(spark)
    joins.assert_unique(products, "product_id")
    with pytest.raises(ValueError, match="duplicate"):
        joins.assert_unique(products.unionByName(products.limit(1)), "product_id")


def test_partition_report_is_sorted_and_complete(spark):
    keyed = partitions.keyed(orders_frame(spark), 4, "product_id")
    rows = partitions.partition_report(keyed, "product_id").collect()
    assert [(r.partition_id, r.product_id) for r in rows] == sorted((r.partition_id, r.product_id) for r in rows)
    assert sum(r.rows for r in rows) == 9 and len({r.product_id for r in rows}) == 4


def test_spread_join_on_a_hot_key(spark):
    at = "2025-03-03T10:00:00+09:00"
    rows = [(i, "tea" if i % 3 else "rye", 1, 100, at) for i in range(300)]
    rows += [(1000, "unknown", 1, 100, at), (1001, None, 1, 100, at), (1002, None, 1, 100, at), (1003, "lime", 1, 100, at)]
    orders, products = orders_frame(spark, rows), products_frame(spark)
    assert sorted(r.product_id for r in joins.hot_keys(orders, "product_id").collect()) == ["rye", "tea"]
    for how in ("inner", "left"):
        plain, spread = orders.join(products, "product_id", how), joins.spread_join(orders, products, "product_id", how)
        assert spread.columns == plain.columns
        assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0
    with pytest.raises(ValueError):
        joins.spread_join(orders, products, "product_id", "full")


def test_hot_rows_are_dealt_over_many_parts(spark):
    """The shuffle of the big side spreads a hot key; Spark would merge such small parts again, so it is told not to."""
    at = "2025-03-03T10:00:00+09:00"
    orders = orders_frame(spark, [(i, "tea", 1, 100, at) for i in range(5000)] + [(9000, "rye", 1, 100, at)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.spread_join(orders, products_frame(spark), "product_id")
        parts = joined.groupBy("product_id", F.spark_partition_id().alias("p")).count().groupBy("product_id").agg(F.count("*").alias("n")).collect()
        sizes = {r.product_id: r.n for r in parts}
        assert joined.count() == 5001 and sizes["tea"] > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_global_rank(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(5)
    got = with_rank(df, F.col("k")).collect()
    assert len(got) == 1000 and all(r.rank == r.k + 1 for r in got)
    assert with_rank(df.limit(0), F.col("k")).count() == 0
