"""Stored joins and joins that spread hot keys, against a plain join."""

import re

import pytest

from salesmart.operators import joins, layout
from salesmart.plans.queries import REGISTRY
from salesmart.session import scratch_path
from salesmart.sources import testdata as td
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has one key, another tenth none."""
    return spark.range(3_000).selectExpr("id AS order_id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 97 END AS product_id", "'x' AS note").repartition(5)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(90).selectExpr("id AS product_id", "concat('p', id) AS name")


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_equal_a_plain_join(spark, facts, dim, how):
    want = rows(facts.join(dim, "product_id", how))
    assert rows(joins.spread_join(facts, dim, "product_id", how)) == want
    stored = layout.store(facts, dim, "product_id", scratch_path(spark, "layout"), buckets=4)
    assert rows(layout.join(spark, stored, how)) == want
    assert spark.read.parquet(stored.hot_facts).filter("product_id = 7").count() == facts.filter("product_id = 7").count() and spark.table(stored.facts).filter("product_id = 7").count() == 0
    layout.forget(spark, stored)


def test_hot_rows_are_dealt_over_many_parts(spark, facts, dim):
    assert joins.hot_keys(facts, "product_id").collect()[0][:2] == (7, 3)  # a third of the rows: more than two of eight shares
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from pyspark.sql import functions as F

        joined = joins.spread_join(facts, dim, "product_id").filter("product_id = 7")
        assert joined.groupBy(F.spark_partition_id()).count().count() >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_other_kinds_of_join_are_refused(spark, facts, dim):
    with pytest.raises(ValueError, match="full"):
        joins.spread_join(facts, dim, "product_id", "full")
    with pytest.raises(ValueError, match="full"):
        layout.join(spark, None, "full")


def test_empty_sides(spark, facts, dim):
    assert joins.spread_join(facts.limit(0), dim, "product_id").count() == 0
    assert joins.spread_join(facts, dim.limit(0), "product_id", "left").count() == 3_000
    stored = layout.store(facts.limit(0), dim.limit(0), "product_id", scratch_path(spark, "layout"), buckets=2)
    assert layout.join(spark, stored, "left").count() == 0


def test_the_stored_join_has_no_exchange_and_scans_the_facts_once(spark):
    text = plan(REGISTRY["q_stored_join"](spark, SF)).split("\n\n")[0]
    assert "SortMergeJoin" in text and not re.search(r"[-:] Exchange \(", text), text
    assert not re.search(r"[-:] Sort \(", text) or text.count("Sort (") <= 2


def test_the_spread_join_scans_the_facts_once_after_counting(spark):
    joined = joins.spread_join(td.order_lines(spark, SF), td.products(spark, SF), "product_id")
    text = plan(joined).split("\n\n")[0] + plan(joined)
    assert len(set(re.findall(r"ReadSchema: struct<[^>]*l_extendedprice[^>]*>", text))) == 1
    assert plan(joined).count("Batched: true\nLocation: InMemoryFileIndex [file:/root/testdata/sf0.001/lineitem.parquet]") == 1
