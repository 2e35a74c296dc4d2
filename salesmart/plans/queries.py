"""Registered queries over the driver's tables (see ``sources.testdata``).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the SQL in :mod:`salesmart.plans.oracle`.  Timestamps and dates are
rendered as text so results do not depend on a client's time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.functions import labels
from salesmart.functions.logs import parse_requests
from salesmart.functions.refine import refine_orders
from salesmart.operators import exports, footers, intake, layout, marts, partitions, quarantine, search, tables
from salesmart.operators.ranking import with_rank
from salesmart.plans import batch, dashboard, incremental, refresh
from salesmart.session import BENCHMARK_SCAN_CONF, DEFAULT_ZONE, materialize, scratch_path
from salesmart.sources import files
from salesmart.sources import testdata as td

SECONDS = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"

# Parameters of the demo queries.  The reference looks up order 1 and keeps
# the first 12 of its 22 orders for its sample; here the sample is the first
# half of the id range, so it grows with the table.  The category stands in
# for the reference's food category.
POINT_ORDER_ID = 1
ABSENT_ORDER_ID = -1
DEMO_DAY = "1995-06-01"
DEMO_CATEGORY = "ECONOMY"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def own_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A session of the same application in the engine's zone, with settings of its own."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        own.conf.set(key, spark.conf.get(key))
    for key, value in {"spark.sql.session.timeZone": DEFAULT_ZONE, **conf}.items():
        own.conf.set(key, value)
    return own


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name.

    Days and hours are those of the engine's zone.  A caller's session with
    another zone is left as it is: the query then runs in a session of its own
    on the same application.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zoned = spark.conf.get("spark.sql.session.timeZone") == DEFAULT_ZONE
        return fn(spark if zoned else own_session(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


def as_text(df: DataFrame, **formats: str) -> DataFrame:
    """Render the named timestamp/date columns with the given patterns."""
    for name, pattern in formats.items():
        df = df.withColumn(name, F.date_format(F.col(name), pattern))
    return df


# --- refinement and enrichment ------------------------------------------------


@query
def q_refined_orders(spark, sf_dir):
    """Amount, typed instant and local date of every order line."""
    return as_text(td.order_lines(spark, sf_dir), ordered_at=SECONDS, order_date=DAY)


@query
def q_enriched_orders(spark, sf_dir):
    """Order lines inner-joined to their product."""
    enriched = marts.enrich(td.order_lines(spark, sf_dir), td.products(spark, sf_dir))
    return as_text(enriched, ordered_at=SECONDS, order_date=DAY)


# --- marts --------------------------------------------------------------------


@query
def q_sales_by_product(spark, sf_dir):
    """A1: sales by product over order lines with a known product."""
    return marts.sales_by_product(td.order_lines(spark, sf_dir), td.products(spark, sf_dir))


@query
def q_broadcast_join_sales(spark, sf_dir):
    """The product mart with the product side broadcast, or shuffled where it is too large for that.

    Facts are aggregated per product first, so the hinted join sees one row
    per product.
    """
    totals = marts.product_totals(td.order_lines(spark, sf_dir))
    return marts.sales_by_product_from_totals(totals, td.products(spark, sf_dir), broadcast_products=True)


@query
def q_sales_by_category(spark, sf_dir):
    """A2: sales by category."""
    return marts.sales_by_category(td.order_lines(spark, sf_dir), td.products(spark, sf_dir))


@query
def q_sales_by_product_in_category(spark, sf_dir):
    """Product summary of one category."""
    return marts.sales_by_product_in_category(
        td.order_lines(spark, sf_dir), td.products(spark, sf_dir), DEMO_CATEGORY
    )


@query
def q_sales_by_day(spark, sf_dir):
    """Sales per order date."""
    return marts.sales_by_day(td.order_lines(spark, sf_dir))


@query
def q_sales_by_hour(spark, sf_dir):
    """A3-A5: hourly sales and share of the total (events cover 24 hours)."""
    return marts.sales_by_hour(td.timed_orders(spark, sf_dir))


@query
def q_total_sales(spark, sf_dir):
    """A4: grand total."""
    return marts.total_sales(td.order_lines(spark, sf_dir))


@query
def q_order_count(spark, sf_dir):
    """Number of order lines, from the footers of their files."""
    return footers.row_count(spark, td.table_path(sf_dir, "lineitem"))


@query
def q_parsed_requests(spark, sf_dir):
    """Every access-log line parsed to a typed request; some lines are damaged."""
    parsed = parse_requests(td.damaged_log_lines(spark, sf_dir))
    return as_text(parsed, requested_at=SECONDS)


@query
def q_log_roundtrip(spark, sf_dir):
    """K8: requests rendered to access-log lines."""
    return td.access_log_lines(spark, sf_dir)


@query
def q_page_views(spark, sf_dir):
    """Page views per day from the parsed access log."""
    return marts.page_views(parse_requests(td.access_log_lines(spark, sf_dir)))


@query
def q_order_preview(spark, sf_dir):
    """Ten highest order ids; ``position`` is the place in the preview."""
    newest = Window.orderBy(F.col("order_id").desc())  # over ten rows
    return marts.order_preview(td.orders(spark, sf_dir)).withColumn("position", F.row_number().over(newest))


@query
def q_dashboard_products(spark, sf_dir):
    """Every product with its totals; products without orders get zeros."""
    orders = td.timed_orders(spark, sf_dir)
    products = td.products(spark, sf_dir)
    return marts.dashboard_products(products, marts.sales_by_product(orders, products))


@query
def q_product_totals_full(spark, sf_dir):
    """Totals before a full join; orders of unknown products are kept."""
    return marts.product_totals_full(
        td.order_lines(spark, sf_dir), td.customers_as_products(spark, sf_dir)
    )


@query
def q_hour_labels(spark, sf_dir):
    """Hour-bucket label of the hourly mart; some orders have no time."""
    by_hour = marts.sales_by_hour(td.partly_timed_orders(spark, sf_dir))
    return by_hour.withColumn("hour_label", labels.hour_label("order_hour"))


@query
def q_category_labels(spark, sf_dir):
    """Category label of the category mart; some products have a NULL or empty category."""
    by_category = marts.sales_by_category(td.order_lines(spark, sf_dir), td.sparse_products(spark, sf_dir))
    return by_category.withColumn("category_label", labels.category_label("category"))


@query
def q_display_names(spark, sf_dir):
    """Display name fallback and rounded average; some products have no name."""
    orders = td.timed_orders(spark, sf_dir)
    products = td.sparse_products(spark, sf_dir)
    shown = marts.dashboard_products(products, marts.sales_by_product(orders, products))
    return shown.select(
        "product_id",
        labels.display_name("product_name", "name", "product_id").alias("display_name"),
        "order_count",
        labels.shown_average("average_order_amount", "order_count").alias("average_shown"),
    )


#: Keywords of the menu rule on the test tables' names and categories.
MENU_WORDS = {"juice_keywords": ("blue", "red"), "cake_keywords": ("ring", "gear"), "bakery_category": "PROMO", "drink_category": "SMALL"}


@query
def q_menu_kind(spark, sf_dir):
    """P25: menu kind from name keywords and category."""
    products = td.products(spark, sf_dir)
    kind = labels.menu_kind("name", "category", **MENU_WORDS)
    return products.select("product_id", "name", "category", kind.alias("menu_kind"))


# --- filters and samples --------------------------------------------------------


def sample_orders(orders: DataFrame) -> DataFrame:
    """Orders whose id is in the first half of the id range (a range filter;
    the bound is a scalar subquery)."""
    half = orders.agg(F.expr("max(order_id) div 2").alias("half"))
    return orders.filter(F.col("order_id") <= half.scalar())


@query
def q_sample_orders(spark, sf_dir):
    """The sampled orders."""
    return as_text(sample_orders(td.orders(spark, sf_dir)), ordered_at=SECONDS, order_date=DAY)


@query
def q_orders_on_day(spark, sf_dir):
    """Orders of one date literal."""
    orders = td.orders(spark, sf_dir)
    day = orders.filter(F.col("order_date") == F.lit(DEMO_DAY).cast("date"))
    return as_text(day, ordered_at=SECONDS, order_date=DAY)


@query
def q_point_lookup(spark, sf_dir):
    """One order by id."""
    return (
        td.orders(spark, sf_dir)
        .filter(F.col("order_id") == POINT_ORDER_ID)
        .select("order_id", "quantity", "amount")
    )


@query
def q_sample_sales_by_day(spark, sf_dir):
    """Daily revenue of all orders."""
    return (
        td.orders(spark, sf_dir).groupBy("order_date")
        .agg(F.sum("amount").alias("revenue"))
        .withColumn("order_date", F.col("order_date").cast("string"))
    )


@query
def q_sample_sales_by_product(spark, sf_dir):
    """Orders with a known product, count and revenue per (product_id, name).

    Aggregated per product before the join, like the product mart.
    """
    totals = marts.product_totals(td.orders(spark, sf_dir))
    named = totals.join(td.customers_as_products(spark, sf_dir).select("product_id", "name"), "product_id")
    return (
        named.groupBy("product_id", "name")
        .agg(F.sum("order_count").alias("order_count"), F.sum("revenue").alias("revenue"))
        .withColumnRenamed("name", "product_name")
    )


# --- aggregation walk-throughs and partitions -------------------------------------


@query
def q_benchmark_sales(spark, sf_dir):
    """A10: count and revenue per product plus the grand-total row."""
    return partitions.benchmark_sales(td.order_lines(spark, sf_dir))


@query
def q_map_reduce_sales(spark, sf_dir):
    """Count, sum and average per product."""
    return marts.key_summary(td.order_lines(spark, sf_dir))


@query
def q_csv_benchmark_sales(spark, sf_dir):
    """The same straight from CSV files, read with the explicit schema and the benchmark's split sizes.

    The sizes are set in a session of the query's own.
    """
    path = scratch_path(spark, "orders-csv")
    exports.write_csv(exports.orders_snapshot(td.raw_order_lines(spark, sf_dir)), path)
    own = own_session(spark, **BENCHMARK_SCAN_CONF)
    return partitions.benchmark_sales(refine_orders(files.read_orders_csv(own, path)))


#: Partitions of the placed reports.
PLACES = 8


@query
def q_partition_sizes(spark, sf_dir):
    """Rows per partition of order lines that are placed by their order id."""
    return partitions.partition_sizes(partitions.placed(td.order_lines(spark, sf_dir), PLACES, F.col("order_id")))


@query
def q_partition_report(spark, sf_dir):
    """Rows of every (partition, product) of order lines placed by product; ``rank`` is the place in that order."""
    lines = partitions.placed(td.order_lines(spark, sf_dir), PLACES, F.col("product_id"))
    return with_rank(partitions.partition_report(lines, "product_id"), F.col("partition_id"), F.col("product_id"))


@query
def q_repartition_sales(spark, sf_dir):
    """Revenue per product after a round-robin repartition."""
    return marts.revenue_by_product(partitions.round_robin(td.order_lines(spark, sf_dir)))


@query
def q_coalesce_sales(spark, sf_dir):
    """Revenue per product after a coalesce that halves the partitions."""
    return marts.revenue_by_product(partitions.merged(td.order_lines(spark, sf_dir)))


@query
def q_keyed_partition_sales(spark, sf_dir):
    """After a keyed repartition of the rows every product sits in one partition."""
    keyed = partitions.keyed(td.order_lines(spark, sf_dir), None, "product_id")
    return partitions.key_locality(keyed, "product_id")


# --- tables -----------------------------------------------------------------------

DEMO_SPLIT_DAY = "1998-01-01"
UPDATE_SET = {"quantity": "2", "amount": "unit_price * 2"}
UPDATE_WHERE = "order_id = 1"


def order_parts(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders before the split day, and all others, those without a date among them."""
    early = F.coalesce(F.col("order_date") < F.lit(DEMO_SPLIT_DAY).cast("date"), F.lit(False))
    return orders.filter(early), orders.filter(~early)


def order_table(spark: SparkSession, sf_dir: str, update: bool = False) -> DataFrame:
    """V5: overwrite with the early orders, append the rest, and update one order in place."""
    path = scratch_path(spark, "orders")
    first, rest = order_parts(td.orders(spark, sf_dir))
    tables.overwrite(rest, path)
    tables.overwrite(first, path)
    tables.append(rest, path)
    if update:
        tables.update(spark, path, UPDATE_SET, UPDATE_WHERE)
    return spark.read.parquet(path)


def load_session(spark: SparkSession) -> SparkSession:
    """A session whose loads use all cores although a folder of the test tables holds a few rows only."""
    return own_session(spark, **{"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"})


def day_table(spark: SparkSession, *parts: DataFrame) -> DataFrame:
    """Orders loaded by day, one part after the other."""
    path = scratch_path(spark, "orders-by-day")
    for part in parts:
        tables.load(part, path, "order_date", sort_by=("order_id",))
    return spark.read.schema(parts[0].schema).parquet(path)


def _order_rows(df: DataFrame) -> DataFrame:
    return as_text(df, ordered_at=SECONDS, order_date=DAY)


@query
def q_versioned_overwrite(spark, sf_dir):
    """K2: a table that held part of the orders after it is overwritten with all."""
    path = scratch_path(spark, "orders")
    orders = td.orders(spark, sf_dir)
    tables.overwrite(order_parts(orders)[0], path)
    tables.overwrite(orders, path)
    return _order_rows(spark.read.parquet(path))


@query
def q_versioned_append(spark, sf_dir):
    """K3: table content after overwrite + append."""
    return _order_rows(order_table(spark, sf_dir))


@query
def q_versioned_update(spark, sf_dir):
    """V1/V4: rows of the table, and rows the conditional update changes."""
    return tables.update_metrics(order_table(spark, sf_dir), UPDATE_WHERE)


@query
def q_versioned_current(spark, sf_dir):
    """V3: the table after overwrite, append and update."""
    return _order_rows(order_table(spark, sf_dir, update=True))


@query
def q_versioned_update_sales(spark, sf_dir):
    """V5 + A9: revenue per product of the updated table."""
    return marts.revenue_by_product(order_table(spark, sf_dir, update=True))


@query
def q_update_files(spark, sf_dir):
    """V1/V4: metrics of an update of one order in a table whose file an order's id decides."""
    path = scratch_path(spark, "orders-placed")
    tables.overwrite(partitions.placed(td.orders(spark, sf_dir), PLACES, F.col("order_id")), path)
    done = tables.update(spark, path, UPDATE_SET, UPDATE_WHERE)
    return spark.createDataFrame([tuple(done.values())], ", ".join(f"{name} long" for name in done))


@query
def q_load_sequence(spark, sf_dir):
    """K2/K3/V5: orders loaded by day in two parts; the second is loaded twice, as after a failure."""
    spark = load_session(spark)
    first, rest = order_parts(td.orders(spark, sf_dir))
    return _order_rows(day_table(spark, first, rest, rest))


@query
def q_day_table_orders(spark, sf_dir):
    """Orders of one date literal from the table by day; the scan lists that day's folder."""
    spark = load_session(spark)
    stored = day_table(spark, td.orders(spark, sf_dir))
    return _order_rows(stored.filter(F.col("order_date") == F.lit(DEMO_DAY).cast("date")))


#: The days of the join with a day dimension: Mondays of one month.
DEMO_MONTH, MONDAY = "1995-06", 0


def days_of(orders: DataFrame) -> DataFrame:
    """Day dimension: order_date, its month and weekday (0 is Monday)."""
    days = orders.select("order_date").distinct()
    return days.withColumns({"month": F.date_format("order_date", "yyyy-MM"), "weekday": F.weekday("order_date")})


@query
def q_day_table_join(spark, sf_dir):
    """Orders of some days of a day dimension; the dimension's filter prunes the scan's folders at run time."""
    spark = load_session(spark)
    orders = td.orders(spark, sf_dir)
    path = scratch_path(spark, "days")
    tables.overwrite(days_of(orders), path)
    chosen = spark.read.parquet(path).filter((F.col("month") == DEMO_MONTH) & (F.col("weekday") == MONDAY))
    return _order_rows(day_table(spark, orders).join(chosen.select("order_date", "month"), "order_date")).drop("month")


# --- intake and lookups -------------------------------------------------------------

SEARCH_TERM = " #12 "
RECEIVED_ID_RANK = 7  # the received order is the 7th newest


@query
def q_validate_orders(spark, sf_dir):
    """Accept or reject every order request."""
    checked = intake.validate_orders(td.order_requests(spark, sf_dir), td.menu(spark, sf_dir))
    return checked.select("request_id", "product_id", "quantity", "quantity_value", "accepted", "reason")


@query
def q_price_snapshot(spark, sf_dir):
    """Accepted requests priced at the product's unit price."""
    checked = intake.validate_orders(td.order_requests(spark, sf_dir), td.menu(spark, sf_dir))
    return intake.price_snapshot(checked, keep=("request_id",))


@query
def q_recent_orders(spark, sf_dir):
    """Fifty newest orders with their product."""
    recent = intake.recent_orders(td.orders(spark, sf_dir), td.customers_as_products(spark, sf_dir))
    return _order_rows(recent)


@query
def q_recent_order_totals(spark, sf_dir):
    """Totals of the fifty newest orders."""
    recent = intake.recent_orders(td.orders(spark, sf_dir), td.customers_as_products(spark, sf_dir))
    return intake.recent_order_totals(recent)


@query
def q_received_order(spark, sf_dir):
    """The received order picked out of the recent list by its id text."""
    orders = td.orders(spark, sf_dir)
    recent = intake.recent_orders(orders, td.customers_as_products(spark, sf_dir))
    newest = orders.select("order_id").orderBy(F.col("order_id").desc()).limit(RECEIVED_ID_RANK)
    received = newest.agg(F.min("order_id").cast("string").alias("id")).scalar()
    return _order_rows(intake.received_order(recent, received))


@query
def q_order_search(spark, sf_dir):
    """P20: search all orders by order number, id or product name."""
    named = marts.enrich(td.orders(spark, sf_dir), td.customers_as_products(spark, sf_dir))
    found = intake.search_orders(named, SEARCH_TERM)
    return found.select("order_id", "product_id", "name", "quantity", "amount")


#: A term with trigrams, which the index serves.
INDEXED_TERM = " #0012 "


def order_index(spark: SparkSession, sf_dir: str) -> str:
    """Path of a search index of all orders."""
    path = scratch_path(spark, "order-index")
    search.build_index(marts.enrich(td.orders(spark, sf_dir), td.customers_as_products(spark, sf_dir)), path)
    return path


@query
def q_order_search_index(spark, sf_dir):
    """P20: the search by a term of four characters, from an index of trigrams."""
    found = search.search(spark, order_index(spark, sf_dir), INDEXED_TERM)
    return found.select("order_id", "product_id", "name", "quantity", "amount")


#: An id within the table's range that no order has in the look-up table.
LOST_ORDER_ID = 7


@query
def q_point_lookup_filter(spark, sf_dir):
    """Two order ids in a table whose row groups have Bloom filters; one of them is not there.

    The table is not sorted by id, so minima and maxima skip nothing.
    """
    path = scratch_path(spark, "orders-lookup")
    orders = td.orders(spark, sf_dir).filter(F.col("order_id") != LOST_ORDER_ID)
    tables.overwrite(partitions.placed(orders, PLACES, F.col("order_id")), path, lookup=("order_id",))
    stored = spark.read.parquet(path)
    found = [stored.filter(F.col("order_id") == k) for k in (POINT_ORDER_ID, LOST_ORDER_ID)]
    return found[0].unionByName(found[1]).select("order_id", "quantity", "amount")


@query
def q_stored_join(spark, sf_dir):
    """Order lines with their product from co-partitioned tables, joined without a shuffle."""
    stored = layout.store(td.order_lines(spark, sf_dir), td.products(spark, sf_dir), "product_id", scratch_path(spark, "layout"))
    return as_text(layout.join(spark, stored), ordered_at=SECONDS, order_date=DAY)


@query
def q_menu_by_category(spark, sf_dir):
    """Menu of one category by product id; ``rank`` is the place in that order."""
    menu = intake.menu_by_category(td.products(spark, sf_dir, with_price=True), DEMO_CATEGORY)
    return with_rank(menu, F.col("product_id"))


@query
def q_menu_categories(spark, sf_dir):
    """Distinct non-empty categories by the first product showing each, with that order's rank."""
    categories = intake.menu_categories(td.sparse_products(spark, sf_dir))
    return with_rank(categories, F.col("first_product_id"), F.col("category"))


# --- exports ------------------------------------------------------------------------


@query
def q_export_orders(spark, sf_dir):
    """Orders snapshot with local ISO-8601 instants."""
    return exports.orders_snapshot(td.orders(spark, sf_dir))


@query
def q_export_products(spark, sf_dir):
    """Products snapshot without the price, by id; ``rank`` is the place in that order."""
    return with_rank(exports.products_snapshot(td.products(spark, sf_dir, with_price=True)), F.col("product_id"))


@query
def q_order_events(spark, sf_dir):
    """K7: one order.created JSON record per order."""
    return exports.order_events(td.orders(spark, sf_dir))


@query
def q_order_event_by_id(spark, sf_dir):
    """K7: the events of one order id and of an id that no order has."""
    wanted = td.orders(spark, sf_dir).filter(F.col("order_id").isin(POINT_ORDER_ID, ABSENT_ORDER_ID))
    return exports.order_events(wanted)


EVENT = "event_type string, order_id long, product_id string, quantity int, unit_price long, amount long, ordered_at string"


@query
def q_event_ingest(spark, sf_dir):
    """K7: the events of every order written as JSON lines and read back as refined orders."""
    path = scratch_path(spark, "events")
    exports.write_events(exports.order_events(td.orders(spark, sf_dir)), path)
    raw = spark.read.schema(EVENT).json(path).drop("event_type", "amount")
    return _order_rows(refine_orders(raw)).select("order_id", "product_id", "quantity", "unit_price", "ordered_at", "amount", "order_date")


@query
def q_order_items_decimal(spark, sf_dir):
    """Order items written as CSV, read back with decimal(10,2), stored as parquet."""
    base = scratch_path(spark, "order-items")
    items = td.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.date_format("l_shipdate", SECONDS).alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("string").alias("price"),
        (F.col("l_extendedprice").cast("decimal(10,2)") * F.col("l_tax").cast("decimal(4,2)"))
        .cast("decimal(10,2)")
        .cast("string")
        .alias("freight_value"),
    )
    items.write.option("header", True).csv(f"{base}/raw")
    typed = files.read_order_items(spark, f"{base}/raw")
    typed.write.parquet(f"{base}/bronze")
    stored = files.read_bronze(spark, f"{base}/bronze")
    money = {c: F.col(c).cast("string") for c in ("price", "freight_value")}
    return as_text(stored, shipping_limit_date=SECONDS).withColumns(money)


# --- dashboard and refresh ---------------------------------------------------------


@query
def q_dashboard_doc(spark, sf_dir):
    """Order count and the row count of every dashboard section.

    The product / day / hour totals come from one scan of the order lines;
    that small result is written, so the sections below read their columns of
    it instead of re-scanning the facts.
    """
    orders = td.order_lines(spark, sf_dir)
    products = td.products(spark, sf_dir)
    requests = parse_requests(td.access_log_lines(spark, sf_dir))
    totals = materialize(marts.fact_totals(orders), "fact-totals")
    sections = batch.build_marts(orders, products, requests, totals)
    order_count = totals.filter(F.col("gid") == marts.BY_DAY_ID).agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count")
    )
    return dashboard.section_sizes(order_count, sections)


def write_raw_zone(spark: SparkSession, sf_dir: str, data_dir: str) -> None:
    """Export the order lines, products and access log as the batch's raw zone."""
    raw = f"{data_dir}/raw"
    lines = td.raw_order_lines(spark, sf_dir).withColumn("product_id", F.col("product_id").cast("string"))
    exports.write_csv(exports.orders_snapshot(lines), f"{raw}/orders.csv")
    products = td.products(spark, sf_dir).withColumn("product_id", F.col("product_id").cast("string"))
    exports.write_json_lines(products, f"{raw}/products.jsonl")
    exports.copy_text(td.access_log_lines(spark, sf_dir), f"{raw}/access.log")


def run_batch(spark: SparkSession, sf_dir: str) -> batch.Zones:
    data_dir = scratch_path(spark, "batch")
    write_raw_zone(spark, sf_dir, data_dir)
    batch.run(spark, data_dir, generated_at="query")
    return batch.Zones(data_dir)


@query
def q_batch_products(spark, sf_dir):
    """L1: the whole raw -> bronze -> silver -> marts batch; its product mart as written."""
    return spark.read.parquet(f"{run_batch(spark, sf_dir).marts}/by_product")


#: The key of each section's rows in the document, and the fields all sections may have.
SECTION_KEYS = {"preview": "order_id", "by_product": "product_id", "by_day": "order_date",
                "page_views": "visit_date", "by_category": "category", "by_hour": "order_hour"}
SECTION_FIELDS = ("order_id string, product_id string, order_date string, visit_date string, category string, order_hour string, "
                  "order_count long, revenue long, sold_quantity long, page_views long, revenue_share_pct double, amount long")


def document_rows(spark: SparkSession, document: str) -> DataFrame:
    """Every row of every written section: section, key and values (NULL where a section has no such field), and its
    place in the section as ``position``."""
    parts = None
    for name, key in SECTION_KEYS.items():
        rows = dashboard.read_section(spark, document, name, SECTION_FIELDS)
        # A file's lines are read in order, split by split.
        place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line")]
        kept = rows.select(F.lit(name).alias("section"), F.col(key).alias("key"), "order_count", "revenue",
                           "sold_quantity", "page_views", "revenue_share_pct", "amount", *place)
        parts = kept if parts is None else parts.unionByName(kept)
    ranked = with_rank(parts, *map(F.col, ("section", "_file", "_start", "_line")), name="_rank")
    first = ranked.groupBy("section").agg((F.min("_rank") - 1).alias("_before"))
    placed = ranked.join(F.broadcast(first), "section").withColumn("position", F.col("_rank") - F.col("_before"))
    return placed.drop("_file", "_start", "_line", "_rank", "_before")


@query
def q_dashboard_rows(spark, sf_dir):
    """All section rows of the document the batch has written, with their places."""
    return document_rows(spark, run_batch(spark, sf_dir).document).filter("section <> 'preview'")


@query
def q_section_sizes(spark, sf_dir):
    """Rows of every mart the batch has written, from the footers of their files in one job."""
    marts_dir = run_batch(spark, sf_dir).marts
    return footers.folder_sizes(spark, {name: f"{marts_dir}/{name}" for name in dashboard.SECTION_ORDER})


@query
def q_refresh_counts(spark, sf_dir):
    """L2: the document holds the orders before the split day; a refresh brings all of them."""
    return _refreshed(spark, sf_dir)[0]


@query
def q_refresh_products(spark, sf_dir):
    """L2: the product section of the document after the refresh."""
    rows = document_rows(spark, _refreshed(spark, sf_dir)[1].document).filter("section = 'by_product'")
    return rows.select(F.col("key").alias("product_id"), "order_count", "revenue", "sold_quantity")


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, batch.Zones]:
    data_dir = scratch_path(spark, "refresh")
    orders = td.orders(spark, sf_dir).withColumn("product_id", F.col("product_id").cast("string"))
    products = td.customers_as_products(spark, sf_dir).withColumn("product_id", F.col("product_id").cast("string"))
    lines = td.access_log_lines(spark, sf_dir)
    refresh.refresh(spark, data_dir, order_parts(orders)[0], products, lines)
    return refresh.refresh(spark, data_dir, orders, products, lines), batch.Zones(data_dir)


# --- refresh of changed periods, quarantine ---------------------------------------------

#: Orders that are cancelled (they vanish) and corrected (their amounts change) between two refreshes.
CANCELLED, CORRECTED = 1000, 777


def changed_orders(orders: DataFrame) -> DataFrame:
    """Orders without the cancelled ones, the corrected ones with twice the quantity."""
    left = orders.filter(F.col("order_id") % CANCELLED != 0)
    twice = F.col("order_id") % CORRECTED == 0
    return left.withColumns({c: F.when(twice, F.col(c) * 2).otherwise(F.col(c)).cast(left.schema[c].dataType) for c in ("quantity", "amount")})


def _incremental(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The early orders, then all (late months come in), then some cancelled and corrected; the last refresh's row."""
    spark = load_session(spark)
    data_dir = scratch_path(spark, "incremental")
    orders, products = td.orders(spark, sf_dir), td.customers_as_products(spark, sf_dir)
    for now in (order_parts(orders)[0], orders):
        incremental.refresh_periods(spark, data_dir, now, grain="month")
    return incremental.refresh(spark, data_dir, changed_orders(orders), products, td.access_log_lines(spark, sf_dir), grain="month"), data_dir


@query
def q_incremental_periods(spark, sf_dir):
    """L2: orders before and after the last refresh, and the months it has computed anew or removed."""
    return _incremental(spark, sf_dir)[0]


@query
def q_incremental_products(spark, sf_dir):
    """L2: the product section after refreshes that compute changed months only."""
    return spark.read.parquet(f"{batch.Zones(_incremental(spark, sf_dir)[1]).marts}/by_product").drop("average_order_amount")


def _scanned_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw files of which some lines are damaged, scanned: orders, products, log."""
    raw = scratch_path(spark, "damaged")
    sources = {"orders.csv": td.damaged_order_csv, "products.jsonl": td.damaged_product_json, "access.log": td.damaged_log_lines}
    for name, lines in sources.items():
        exports.copy_text(lines(spark, sf_dir), f"{raw}/{name}")
    orders = materialize(files.scan_orders_csv(spark, f"{raw}/orders.csv", header=False), "bronze")
    products = materialize(files.scan_products_jsonl(spark, f"{raw}/products.jsonl"), "bronze")
    return orders, products, files.scan_access_log(spark, f"{raw}/access.log")


@query
def q_quarantined_lines(spark, sf_dir):
    """Every line that could not be read whole, with its source and the reason."""
    orders, products, lines = _scanned_raw(spark, sf_dir)
    rejects = [quarantine.split_orders(orders)[1], quarantine.split_products(products)[1], quarantine.split_log(lines)[1]]
    return rejects[0].unionByName(rejects[1]).unionByName(rejects[2]).drop("file")


@query
def q_clean_orders(spark, sf_dir):
    """The orders that quarantine leaves, refined; an unreadable time is NULL."""
    return _order_rows(refine_orders(quarantine.split_orders(_scanned_raw(spark, sf_dir)[0])[0]))
