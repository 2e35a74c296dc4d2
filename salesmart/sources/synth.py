"""Deterministic synthetic orders and products, generated in parallel.

Row ``i`` (0-based): order_id i+1, product ``P%03d`` of i % 100, quantity
i % 5 + 1, unit_price (i % 10 + 1) * 100 and one constant instant.  Product
``j``: name ``상품 %03d``, category ``분류 %d`` of j % 5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import default_parallelism

# Fixed values of the generator rule.
PRODUCT_COUNT = 100
CATEGORY_COUNT = 5
ORDERED_AT = "2026-09-07T10:00:00+09:00"
PRODUCT_ID_FORMAT = "P%03d"
PRODUCT_NAME_FORMAT = "상품 %03d"
CATEGORY_FORMAT = "분류 %d"


# Rows generated per task when no partition count is given (a few hundred MB).
ROWS_PER_PARTITION = 10_000_000


def orders(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """``n`` raw orders; each task generates its own id range (no driver data).

    Without ``num_partitions`` there is one task per ROWS_PER_PARTITION rows,
    and at least the session's default parallelism.
    """
    if num_partitions is None:
        num_partitions = max(default_parallelism(spark), -(-n // ROWS_PER_PARTITION))
    i = F.col("id")
    return spark.range(0, n, numPartitions=num_partitions).select(
        (i + 1).alias("order_id"),
        F.format_string(PRODUCT_ID_FORMAT, i % PRODUCT_COUNT).alias("product_id"),
        (i % 5 + 1).cast("int").alias("quantity"),
        ((i % 10 + 1) * 100).cast("long").alias("unit_price"),
        F.lit(ORDERED_AT).alias("ordered_at"),
    )


def products(spark: SparkSession) -> DataFrame:
    j = F.col("id")
    return spark.range(PRODUCT_COUNT, numPartitions=1).select(
        F.format_string(PRODUCT_ID_FORMAT, j).alias("product_id"),
        F.format_string(PRODUCT_NAME_FORMAT, j).alias("name"),
        F.format_string(CATEGORY_FORMAT, j % CATEGORY_COUNT).alias("category"),
    )


def write_raw(spark: SparkSession, n: int, raw_dir: str, num_partitions: int | None = None) -> None:
    """Write ``orders.csv`` (a directory of parts), ``products.jsonl`` and a one-line log."""
    orders(spark, n, num_partitions).write.mode("overwrite").option("header", True).csv(f"{raw_dir}/orders.csv")
    products(spark).coalesce(1).write.mode("overwrite").json(f"{raw_dir}/products.jsonl")
    spark.range(1).select(F.lit(f"{ORDERED_AT} GET /products/ 200 12").alias("value")).write.mode(
        "overwrite"
    ).text(f"{raw_dir}/access.log")
