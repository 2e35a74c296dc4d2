"""Partition operators and diagnostics (R1-R7) and the aggregation walk-throughs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition (``partition_id``, ``rows``)."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def partition_report(df: DataFrame, key: str) -> DataFrame:
    """R1/R4 + T4: rows per (partition_id, key), sorted by partition then key.

    One row per partition and key (an aggregate), so the sorted report is as
    small as the number of partitions times keys per partition.
    """
    tagged = df.withColumn("partition_id", F.spark_partition_id())
    return tagged.groupBy("partition_id", key).agg(F.count(F.lit(1)).alias("rows")).orderBy("partition_id", key)


def partition_count(df: DataFrame) -> int:
    """Number of partitions of the plan's output (no job is run).

    Spark Connect has no RDD view; there the distinct partition ids of a
    one-column projection are counted instead (a job, counting only
    non-empty partitions).
    """
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - Connect DataFrames have no .rdd
        return df.select(F.spark_partition_id().alias("p")).distinct().count()


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def round_robin(df: DataFrame, n: int | None = None) -> DataFrame:
    """R2: spread rows evenly over ``n`` partitions (a full shuffle).

    Without ``n`` the session's ``spark.sql.shuffle.partitions`` is used, which
    is the count sized for the data; a small fixed count only suits small data.
    """
    return df.repartition(n or _shuffle_partitions(df))


def merged(df: DataFrame, n: int | None = None) -> DataFrame:
    """Merge into at most ``n`` partitions without a shuffle.

    Without ``n`` the partition count is halved, so the scan keeps half its
    parallelism instead of collapsing into a fixed handful of tasks.
    """
    if n is None:
        n = max(1, partition_count(df) // 2)
    return df.coalesce(n)


def keyed(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """Hash-partition on ``keys`` so all rows of a key share one partition.

    A hot key puts all its rows in one task: use it where a task must see all
    rows of a key; totals need no repartition, since aggregates combine first.
    """
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def placed(df: DataFrame, n: int, number: Column) -> DataFrame:
    """Put every row in partition ``number`` modulo ``n`` (a whole number; NULL counts as 0).

    Placement is the caller's, not a hash: a reader, or SQL, can name the
    partition and so the file of a row.  A value that holds many rows fills its
    partition; use it for ids, or with a number that spreads them.
    """
    return df.repartitionById(n, F.coalesce(F.pmod(number, F.lit(n)), F.lit(0)).cast("int"))


def key_locality(df: DataFrame, key: str) -> DataFrame:
    """Per key: number of partitions holding it (1 after :func:`keyed`), count, revenue.

    The set of partition ids per key is bounded by the partition count.
    """
    tagged = df.withColumn("_partition", F.spark_partition_id())
    return tagged.groupBy(key).agg(
        F.size(F.collect_set("_partition")).alias("partition_count"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("amount").alias("revenue"),
    )


def benchmark_sales(orders: DataFrame) -> DataFrame:
    """A10: count and revenue per product plus one grand-total row (``is_total`` = 1).

    The total is rolled up from the rows per product, so only those are
    expanded, not the orders.
    """
    per_product = orders.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"))
    return per_product.rollup("product_id").agg(
        F.grouping("product_id").cast("int").alias("is_total"),
        F.sum("n").alias("order_count"),
        F.sum("s").alias("revenue"),
    )


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (what ``df.explain(mode)`` prints)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
