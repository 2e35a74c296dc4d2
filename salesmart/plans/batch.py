"""L1: raw -> bronze -> silver -> marts -> dashboard document, as one Spark job set.

Zones under ``data_dir``::

    raw/orders.csv, raw/products.jsonl, raw/access.log
    lake/bronze/orders    parquet, raw schema and the text of malformed lines (overwrite); products alike
    lake/silver/orders    parquet, refined schema (overwrite)
    lake/rejects          lines that could not be read: source, reason, line, file
    marts/<section>       parquet mart tables
    document/<section>    every section as sorted JSON lines, document/summary the head

Every mart reads the silver *re-read*, which also cuts the lineage back to
the CSV scan.
"""

from __future__ import annotations

import datetime as _dt
from time import perf_counter
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.logs import parse_requests
from salesmart.functions.refine import refine_orders
from salesmart.operators import joins, marts, quarantine, tables
from salesmart.plans import dashboard
from salesmart.sources import files


class Zones:
    def __init__(self, data_dir: str):
        d = data_dir.rstrip("/")
        self.raw = f"{d}/raw"
        self.bronze = f"{d}/lake/bronze/orders"
        self.silver = f"{d}/lake/silver/orders"
        self.bronze_products = f"{d}/lake/bronze/products"
        self.rejects = f"{d}/lake/rejects"
        self.marts = f"{d}/marts"
        self.document = f"{d}/document"


# Silver is sorted by (order_date, order_id) within each file, so parquet
# min/max statistics let day filters and order lookups skip row groups without
# creating one folder per day.  Partitioning by day as well pays off once each
# day holds hundreds of MB (cluster scale): pass partition_by=("order_date",).
SILVER_CLUSTER_BY = ("order_date", "order_id")


def load_silver(
    spark: SparkSession, zones: Zones, strict: bool = False, partition_by: tuple[str, ...] = (), drop_malformed: bool = True
) -> tuple[DataFrame, DataFrame]:
    """S1 -> K1 -> S4 -> refine -> K2: write bronze and silver; silver read back, and the rejected lines of bronze.

    Bronze holds every line, a malformed one as its text; silver holds the
    rows that could be read.
    """
    tables.overwrite(files.scan_orders_csv(spark, f"{zones.raw}/orders.csv"), zones.bronze)
    good, rejects = quarantine.split_orders(files.read_bronze(spark, zones.bronze), drop_malformed)
    refined = refine_orders(good, strict=strict)
    tables.overwrite(refined.sortWithinPartitions(*SILVER_CLUSTER_BY), zones.silver, partition_by, lookup=("order_id",))
    return spark.read.schema(refined.schema).parquet(zones.silver), rejects


def load_products(spark: SparkSession, zones: Zones) -> tuple[DataFrame, DataFrame]:
    """Bronze products read back, and the rejected lines."""
    tables.overwrite(files.scan_products_jsonl(spark, f"{zones.raw}/products.jsonl"), zones.bronze_products)
    return quarantine.split_products(files.read_bronze(spark, zones.bronze_products))


def load_requests(spark: SparkSession, zones: Zones, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """S3: typed requests and the rejected lines.  The log is parsed for each: page views need one group of a line only."""
    lines, rejects = quarantine.split_log(files.scan_access_log(spark, f"{zones.raw}/access.log"))
    return parse_requests(lines, strict=strict), rejects


def build_marts(orders: DataFrame, products: DataFrame, requests: DataFrame, totals: DataFrame | None = None) -> dict[str, DataFrame]:
    """All mart sections from refined orders, products and parsed requests.

    ``totals`` is :func:`marts.fact_totals` of ``orders`` (computed here when
    not given): product, day and hour marts all come from that one scan.
    """
    if totals is None:
        totals = marts.fact_totals(orders)
    per_product = marts.totals_of(totals, marts.BY_PRODUCT_ID, "product_id")
    by_product = marts.sales_by_product_from_totals(per_product, products)
    per_day = marts.totals_of(totals, marts.BY_DAY_ID, "order_date").drop("sold_quantity")
    per_hour = marts.totals_of(totals, marts.BY_HOUR_ID, "order_hour").drop("sold_quantity")
    return {
        "preview": marts.order_preview(orders),
        "by_product": marts.dashboard_products(products, by_product),
        "by_day": marts.day_text(per_day),
        "page_views": marts.page_views(requests),
        "by_category": marts.sales_by_category_from_totals(per_product, products),
        "by_hour": marts.with_revenue_share(per_hour),
    }


def run(
    spark: SparkSession,
    data_dir: str,
    generated_at: str | None = None,
    strict: bool = False,
    unique_products: bool = False,
    partition_by: tuple[str, ...] = (),
    drop_malformed: bool = True,
) -> dict:
    """Run the whole batch and return the head of the dashboard document.

    ``unique_products`` fails the run when a product id repeats (it would fan
    out orders in the joins); off by default, as in the reference.  A malformed
    order line is only among the rejects; without ``drop_malformed`` it is an
    order too, with NULL fields.
    """
    started = perf_counter()
    zones = Zones(data_dir)
    orders, bad_orders = load_silver(spark, zones, strict, partition_by, drop_malformed)
    products, bad_products = load_products(spark, zones)
    if unique_products:
        joins.assert_unique(products, "product_id")
    requests, bad_lines = load_requests(spark, zones, strict)
    # One scan of silver for every product / day / hour total; each grouping
    # set is a folder of its own, so a mart reads its totals only.
    marts.fact_totals(orders).write.mode("overwrite").partitionBy("gid").parquet(f"{zones.marts}/fact_totals")
    totals = spark.read.parquet(f"{zones.marts}/fact_totals")
    for name, df in build_marts(orders, products, requests, totals).items():
        tables.overwrite(df, f"{zones.marts}/{name}")
    if generated_at is None:
        zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
        generated_at = _dt.datetime.now(zone).isoformat(timespec="seconds")
    by_day = totals.filter(F.col("gid") == marts.BY_DAY_ID)
    head = {"generated_at": generated_at, "order_count": by_day.agg(F.sum("order_count")).first()[0] or 0}
    tables.overwrite(bad_orders.unionByName(bad_products).unionByName(bad_lines), zones.rejects)
    rejected = quarantine.counts(spark.read.parquet(zones.rejects))
    for name, source in (("orders", "orders"), ("products", "products"), ("log_lines", "access_log")):
        head[f"rejected_{name}"] = sum(n for (s, _), n in rejected.items() if s == source)
    dashboard.write_sections(spark, zones.marts, zones.document)
    head |= dashboard.bounded_sections(spark, zones.document)
    head["pipeline_seconds"] = round(perf_counter() - started, 3)
    dashboard.write_summary(spark, head, zones.document)
    return head
