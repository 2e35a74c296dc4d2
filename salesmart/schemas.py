"""Explicit schemas of the order model (schemas are never inferred).

Fixed values: the column names and types of the raw files.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RAW_ORDER = StructType(
    [
        StructField("order_id", LongType()),
        StructField("product_id", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", LongType()),
        StructField("ordered_at", StringType()),
    ]
)

PRODUCT_DDL = "product_id string, name string, category string"

PARSED_REQUEST = StructType(
    [
        StructField("requested_at", TimestampType()),
        StructField("method", StringType()),
        StructField("path", StringType()),
        StructField("status", IntegerType()),
        StructField("duration_ms", LongType()),
        StructField("visit_date", StringType()),
    ]
)

ORDER_ITEM = StructType(
    [
        StructField("order_id", StringType()),
        StructField("order_item_id", IntegerType()),
        StructField("product_id", StringType()),
        StructField("seller_id", StringType()),
        StructField("shipping_limit_date", TimestampType()),
        StructField("price", DecimalType(10, 2)),
        StructField("freight_value", DecimalType(10, 2)),
    ]
)
