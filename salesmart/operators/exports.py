"""Snapshot exports and order events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.logs import ISO_SECONDS

# Fixed value: the event type of an exported order.
ORDER_CREATED = "order.created"


def orders_snapshot(orders: DataFrame) -> DataFrame:
    """order_id, product_id, quantity, unit_price, ordered_at as local ISO-8601 with offset."""
    return orders.select(
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        F.date_format("ordered_at", ISO_SECONDS).alias("ordered_at"),
    )


def products_snapshot(products: DataFrame) -> DataFrame:
    """product_id, name, category (the price is not exported)."""
    return products.select("product_id", "name", "category")


def order_events(orders: DataFrame) -> DataFrame:
    """K7: one ``order.created`` JSON record per order (column ``event``)."""
    payload = F.struct(
        F.lit(ORDER_CREATED).alias("event_type"),
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "amount",
        F.date_format("ordered_at", ISO_SECONDS).alias("ordered_at"),
    )
    return orders.select("order_id", F.to_json(payload).alias("event"))


def _ordered(df: DataFrame, order_by: str | None) -> DataFrame:
    # A global sort range-partitions the rows, so part files come out in key
    # order (part-00000 holds the smallest keys) without a single-task step.
    return df.orderBy(order_by) if order_by else df


def write_csv(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """CSV with a header; ``order_by`` writes the rows in key order across the part files."""
    _ordered(df, order_by).write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """JSON lines; Spark writes UTF-8 text without escaping non-ASCII."""
    _ordered(df, order_by).write.mode("overwrite").json(path)


def write_events(events: DataFrame, path: str) -> None:
    events.select("event").write.mode("overwrite").text(path)


def copy_text(df_lines: DataFrame, path: str) -> None:
    """Copy log lines unchanged."""
    df_lines.write.mode("overwrite").text(path)
