"""Assumptions the registered queries make about the driver's tables."""

from pyspark.sql import functions as F

from salesmart.sources import testdata as td

SF = "/root/testdata/sf0.01"


def test_order_line_mapping(spark):
    lines = td.order_lines(spark, SF)
    raw = td.table(spark, SF, "lineitem")
    assert lines.count() == raw.count()
    # Quantities are whole numbers, so the int cast loses nothing.
    assert raw.filter(F.col("l_quantity") != F.floor("l_quantity")).count() == 0
    # Per line, amount = quantity * unit_price stays below the line's cents by
    # less than one unit (l_orderkey, l_partkey is not a key, so no join here).
    per_line = raw.select(
        F.col("l_quantity").cast("int").alias("q"),
        td.cents("l_extendedprice").alias("cents"),
        (F.col("l_quantity").cast("int") * F.floor(td.cents("l_extendedprice") / F.col("l_quantity").cast("int")))
        .cast("long").alias("amount"),
    )
    bad = per_line.filter((F.col("amount") > F.col("cents")) | (F.col("cents") - F.col("amount") >= F.col("q")))
    assert bad.count() == 0
    assert lines.agg(F.sum("amount")).first()[0] == per_line.agg(F.sum("amount")).first()[0]


def test_timed_orders_cover_every_hour(spark):
    hours = td.timed_orders(spark, SF).select(F.hour("ordered_at").alias("h")).distinct().count()
    assert hours == 24


def test_pairings_give_products_without_orders_and_orders_without_products(spark):
    products = td.products(spark, SF)
    timed = td.timed_orders(spark, SF)
    assert products.join(timed, "product_id", "left_anti").count() > 0
    lines = td.order_lines(spark, SF)
    customers = td.customers_as_products(spark, SF)
    assert lines.join(customers, "product_id", "left_anti").count() > 0


def test_order_ids_are_unique_in_orders(spark):
    orders = td.orders(spark, SF)
    assert orders.count() == orders.select("order_id").distinct().count()
