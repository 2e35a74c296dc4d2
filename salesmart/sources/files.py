"""Raw-zone readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesmart import schemas


def read_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    """Orders CSV: header line skipped, columns bound by position, PERMISSIVE."""
    return spark.read.schema(schemas.RAW_ORDER).option("header", True).csv(path)


def read_products_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Products as JSON lines with the DDL schema ``product_id, name, category``."""
    return spark.read.schema(schemas.PRODUCT_DDL).json(path)


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per log line in column ``value``."""
    return spark.read.text(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_order_items(spark: SparkSession, path: str) -> DataFrame:
    """Order items CSV with ``decimal(10,2)`` money and timestamp columns."""
    return spark.read.schema(schemas.ORDER_ITEM).option("header", True).csv(path)


#: Column that holds the line of a row that could not be read.
REJECTED = "rejected_line"


def _tolerant(spark: SparkSession, schema: StructType):
    kept = StructType([*schema.fields, StructField(REJECTED, StringType())])
    return spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)


def scan_orders_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Orders CSV with ``rejected_line`` (NULL for a row that was read whole) and ``file``."""
    # A malformed value in a column that is not read would go unseen, so all columns are parsed.
    rows = _tolerant(spark, schemas.RAW_ORDER).option("header", header).option("columnPruning", "false").csv(path)
    return rows.withColumn("file", F.col("_metadata.file_name"))


def scan_products_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Products as JSON lines with ``rejected_line`` and ``file``."""
    rows = _tolerant(spark, StructType.fromDDL(schemas.PRODUCT_DDL)).json(path)
    return rows.withColumn("file", F.col("_metadata.file_name"))


def scan_access_log(spark: SparkSession, path: str) -> DataFrame:
    """Access-log lines in ``value`` with ``file``."""
    return spark.read.text(path).withColumn("file", F.col("_metadata.file_name"))
