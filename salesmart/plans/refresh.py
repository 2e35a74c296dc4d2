"""L2: refresh = old order count -> export -> batch -> new order count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators import exports
from salesmart.plans import batch, dashboard


def current_count(spark: SparkSession, zones: batch.Zones) -> int:
    """Order count of the document; 0 before the first batch."""
    head = dashboard.read_summary(spark, zones.document)
    return head["order_count"] if head else 0


def refresh(spark: SparkSession, data_dir: str, orders: DataFrame, products: DataFrame, log_lines: DataFrame) -> DataFrame:
    """Export the operational tables, run the whole batch, report the document's count before and after.

    The frames are the operational tables (``read.jdbc`` in production):
    ``orders`` with order_id, product_id, quantity, unit_price and an
    ``ordered_at`` timestamp, ``products`` with product_id, name and category,
    and the access log's lines in ``value``.
    """
    zones = batch.Zones(data_dir)
    before = current_count(spark, zones)
    exports.write_csv(exports.orders_snapshot(orders), f"{zones.raw}/orders.csv", order_by="order_id")
    exports.write_json_lines(exports.products_snapshot(products), f"{zones.raw}/products.jsonl", order_by="product_id")
    exports.copy_text(log_lines, f"{zones.raw}/access.log")
    batch.run(spark, data_dir)
    return spark.createDataFrame([(before, current_count(spark, zones))], "before_count long, after_count long")
