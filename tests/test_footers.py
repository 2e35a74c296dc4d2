"""Counts from footers, placement by number, dynamic pruning, settings of own sessions."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators import footers, partitions
from salesmart.plans import queries
from salesmart.plans.queries import REGISTRY
from salesmart.session import BENCHMARK_SCAN_CONF
from salesmart.sources import testdata as td
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


def test_the_order_count_is_pushed_into_the_scan(spark):
    text = plan(REGISTRY["q_order_count"](spark, SF))
    assert "PushedAggregation: [COUNT(*)]" in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as before


def test_sizes_of_folders_read_no_column(spark, scratch):
    spark.range(7).write.parquet(f"{scratch}/a")
    spark.range(3).selectExpr("id", "id AS v").write.partitionBy("id").parquet(f"{scratch}/b")
    spark.range(0).write.parquet(f"{scratch}/ab")
    sizes = footers.folder_sizes(spark, {n: f"{scratch}/{n}" for n in ("a", "b", "ab")})
    assert {tuple(r) for r in sizes.collect()} == {("a", 7), ("b", 3), ("ab", 0)}
    assert "ReadSchema: struct<>" in plan(sizes)


def test_rows_are_placed_by_number(spark):
    rows = spark.range(50).withColumn("k", F.when(F.col("id") < 40, F.col("id") - 20))
    got = partitions.placed(rows, 4, F.col("k")).withColumn("p", F.spark_partition_id()).collect()
    assert all(r.p == (r.k or 0) % 4 for r in got) and partitions.partition_count(partitions.placed(rows, 4, F.col("k"))) == 4


def test_a_day_literal_lists_one_folder(spark):
    day = REGISTRY["q_day_table_orders"](spark, SF)
    text = plan(day)
    assert "PartitionFilters: [isnotnull(order_date" in text and "= 1995-06-01" in text


def test_a_day_dimension_prunes_at_run_time(spark):
    assert "dynamicpruningexpression" in plan(REGISTRY["q_day_table_join"](spark, SF))


def test_split_sizes_are_set_in_the_query_only(spark):
    before = {k: spark.conf.get(k, None) for k in BENCHMARK_SCAN_CONF}
    own = queries.own_session(spark, **BENCHMARK_SCAN_CONF)
    assert {k: own.conf.get(k) for k in BENCHMARK_SCAN_CONF} == BENCHMARK_SCAN_CONF
    REGISTRY["q_csv_benchmark_sales"](spark, SF)
    assert {k: spark.conf.get(k, None) for k in BENCHMARK_SCAN_CONF} == before


@pytest.mark.parametrize("name", ["q_partition_sizes", "q_partition_report"])
def test_reports_cover_every_row(spark, name):
    rows = REGISTRY[name](spark, SF).agg(F.sum("rows")).first()[0]
    assert rows == td.order_lines(spark, SF).count()
