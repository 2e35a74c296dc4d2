"""Row counts from Parquet footers (A8, A20): no column of a row is read.

One table's count is pushed into the scan as an aggregate, which Spark's
DataSource V2 reader answers from the footers.  The sizes of many folders come
from one scan of them all that asks for no column, grouped by folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FOOTER_CONF = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",  # all but parquet
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans take aggregates; the caller's stays as it is."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    for key, value in FOOTER_CONF.items():
        own.conf.set(key, value)
    return own


def row_count(spark: SparkSession, path: str, name: str = "order_count") -> DataFrame:
    """One row with the number of rows of a stored table."""
    return footer_session(spark).read.parquet(path).agg(F.count(F.lit(1)).alias(name))


def folder_sizes(spark: SparkSession, paths: dict[str, str], label: str = "section") -> DataFrame:
    """(label, rows) of every named folder, those without a row too, in one job.

    The names are given by the caller, so their list is short.
    """
    names = spark.createDataFrame([(n,) for n in paths], f"{label} string")
    stored = spark.read.option("recursiveFileLookup", "true").schema(StructType([])).parquet(*paths.values())
    folder: Column = F.lit(None).cast("string")
    for name, path in paths.items():
        folder = F.when(F.col("_metadata.file_path").contains(f"{_below_root(path)}/"), F.lit(name)).otherwise(folder)
    counted = stored.select(folder.alias(label)).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    return names.join(F.broadcast(counted), label, "left").select(label, F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def _below_root(path: str) -> str:
    """A path without scheme, authority and trailing slash."""
    return path.split("://", 1)[-1].rstrip("/") if "://" in path else path.removeprefix("file:").rstrip("/")
